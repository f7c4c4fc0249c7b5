"""Streams over a folder of JSON files, one file per micro-batch, against batch results."""

import json
import os
import random
import subprocess
import sys
import threading
import time
from datetime import datetime, timezone
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tapewatch.operators import runmetrics
from tapewatch.operators.classify import load_clusters
from tapewatch.operators.joins import trades_in_windows
from tapewatch.operators.ordering import ArrivalOrder
from tapewatch.operators.series import last_n_per_symbol
from tapewatch.operators.windows import merge_fragments, window_stats
from tapewatch.plans import flow
from tapewatch.sources import published
from tapewatch.sources.sinks import append_parquet
from tapewatch.sources.trades import FileSource, KafkaSource, trade_batch, trade_stream
from tapewatch.streaming import run, state, windows
from tapewatch.streaming.live import keep_newest, newest_trades, state_rows, stream_trades_in_windows
from tapewatch.streaming.progress import ProgressTable, read_progress

BASE = int(datetime(2024, 5, 1, 12, tzinfo=timezone.utc).timestamp() * 1000)
COLUMNS = ["symbol", "window_start", "window_end", "price_min", "price_max", "price_avg", "price_variance",
           "trade_count", "total_volume", "price_first", "price_last"]


class Folder:
    def __init__(self, path):
        self.path, self.n, self.start = path, 0, time.time() - 1000
        path.mkdir()

    def add(self, *trades):
        lines = [json.dumps({"symbol": s, "price": p, "quantity": 1.0, "timestamp": BASE + t * 1000,
                             "is_buyer_maker": True}) for s, p, t in trades]
        file = self.path / f"{self.n:04d}.txt"
        file.write_text("\n".join(lines) + "\n")
        # the file source takes files by age; distinct times keep the batches in order
        os.utime(file, (self.start + self.n, self.start + self.n))
        self.n += 1
        return self

    @property
    def source(self):
        return FileSource(str(self.path), max_files_per_trigger=1)


@pytest.fixture
def folder(tmp_path):
    return Folder(tmp_path / "in")


def exact(spark, folder, tmp_path, restart=False):
    out = str(tmp_path / "out")
    live = windows.stream_window_stats(trade_stream(spark, folder.source))
    q = run.run_to_parquet(live, out, str(tmp_path / "ck"), interval=None)
    q.awaitTermination()
    return spark.read.parquet(out), q


def rows(df):
    def plain(v):
        return "none" if v is None else round(v, 9) if isinstance(v, float) else v
    return sorted(tuple(map(plain, r)) for r in df.select(*COLUMNS).collect())


def seconds(r):
    return int(r.window_start.replace(tzinfo=timezone.utc).timestamp()) - BASE // 1000


def test_exact_windows_equal_batch_for_closed_windows(spark, folder, tmp_path):
    for i in range(6):
        folder.add(*[(s, 100.0 + i + j, 20 * i + j) for j in range(5) for s in "AB"])
    streamed, _ = exact(spark, folder, tmp_path)
    trades = trade_batch(spark, folder.source)
    want = windows.closed_windows(window_stats(trades), trades, 30)
    assert 0 < want.count() < window_stats(trades).count()
    assert rows(streamed) == rows(want)


def test_restart_continues_without_duplicates(spark, folder, tmp_path):
    for i in range(3):
        folder.add(("A", 1.0 + i, 40 * i))
    first, _ = exact(spark, folder, tmp_path)
    n = first.count()
    for i in range(3, 7):
        folder.add(("A", 1.0 + i, 40 * i))
    both, _ = exact(spark, folder, tmp_path)
    trades = trade_batch(spark, folder.source)
    assert both.count() > n
    assert rows(both) == rows(windows.closed_windows(window_stats(trades), trades, 30))


def test_late_trade_counts_only_for_the_window_still_open(spark, folder, tmp_path):
    # Watermark after file 2 is 125 - 30 = 95: window [30, 90) is closed, [60, 120) still open.
    # Lateness is judged by the watermark of one batch earlier, hence the third file.
    folder.add(("A", 1.0, 70)).add(("A", 2.0, 125)).add(("A", 2.0, 126)).add(("A", 9.0, 75)).add(("A", 3.0, 300))
    streamed, q = exact(spark, folder, tmp_path)
    counts = {seconds(r): r.trade_count for r in streamed.collect()}
    assert counts[30] == 1 and counts[60] == 2
    assert run.late_rows(q) >= 1


def test_late_trade_in_the_next_batch_still_counts(spark, folder, tmp_path):
    folder.add(("A", 1.0, 70)).add(("A", 2.0, 125)).add(("A", 9.0, 75)).add(("A", 3.0, 300))
    streamed, _ = exact(spark, folder, tmp_path)
    counts = {seconds(r): r.trade_count for r in streamed.collect()}
    assert counts[30] == 2 and counts[60] == 2


def test_fragments_keep_late_trades_and_merge_to_exact(spark, folder, tmp_path):
    folder.add(("A", 1.0, 10), ("A", 2.0, 20)).add(("A", 5.0, 40)).add(("A", 3.0, 200)).add(("A", 4.0, 15))
    out = str(tmp_path / "frag")
    live = windows.with_watermark(trade_stream(spark, folder.source))
    run.run_foreach_batch(live, windows.fragment_writer(out), str(tmp_path / "ck"), interval=None).awaitTermination()
    fragments = spark.read.parquet(out)
    batch = window_stats(trade_batch(spark, folder.source))
    assert fragments.count() > batch.count()
    assert rows(merge_fragments(fragments, "batch_id")) == rows(batch)


def test_empty_batch_writes_nothing(spark, tmp_path):
    empty = spark.createDataFrame([], "symbol string, price double, quantity double, event_time timestamp")
    windows.fragment_writer(str(tmp_path / "none"))(empty, 0)
    assert not (tmp_path / "none").exists()


def test_retried_batch_replaces_itself(spark, tmp_path):
    for batch in (0, 1, 1):
        counts = append_parquet(spark.range(5), str(tmp_path / "t"), batch, even=F.col("id") % 2 == 0)
        assert counts == {"rows": 5, "even": 3}
    assert spark.read.parquet(str(tmp_path / "t")).count() == 10


def test_run_for_stops_a_live_query(spark, folder, tmp_path):
    folder.add(("A", 1.0, 1))
    live = trade_stream(spark, folder.source)
    q = run.run_to_parquet(live, str(tmp_path / "o"), str(tmp_path / "c"), interval="1 second")
    assert run.run_for(q, 4) is False and not q.isActive
    assert spark.read.parquet(str(tmp_path / "o")).count() == 1
    assert [b for b, n, _, _ in run.progress_rates(q) if n] == [0]


def test_whole_flow(spark, folder, tmp_path):
    """Accumulate, label, train, then score the same stream with the fitted model."""
    import random
    random.seed(5)
    for i in range(4):
        folder.add(*[(s, 100 + random.gauss(0, 1 if random.random() < 0.95 else 30), i * 600 + t)
                     for t in range(0, 600, 6) for s in "AB"])
    path = lambda name: str(tmp_path / name)
    features = flow.accumulate(spark, folder.source, path("acc"), path("acc-ck"), 300, interval=None)
    choice = flow.label_windows(features, path("labeled"), path("kmeans"))
    assert len(load_clusters(path("kmeans")).clusterCenters()) == choice.k
    assert choice.k in (3, 4, 5) and choice.score == max(choice.scores.values())
    labeled = spark.read.parquet(path("labeled"))
    assert 0 < labeled.filter("label = 'anomalo'").count() <= 0.05 * labeled.count() + 1
    model, metrics, scored = flow.train_classifier(labeled, path("classifier"))
    assert metrics["accuracy"] == pytest.approx(metrics["weighted_recall"]) and 0 <= metrics["auc_roc"] <= 1
    predictions = flow.infer(spark, folder.source, model, path("pred"), path("pred-ck"), 300, interval=None)
    assert predictions.count() == features.count()
    out = path("scored-fragments")
    run.run_foreach_batch(trade_stream(spark, folder.source), windows.fragment_scorer(model, out), path("fs-ck"),
                          interval=None).awaitTermination()
    assert spark.read.parquet(out).select("prediction", "probability").count() >= predictions.count()


def test_large_state_store(spark, folder, tmp_path):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    run.use_large_state(spark)
    try:
        folder.add(("A", 1.0, 10)).add(("A", 2.0, 500))
        assert exact(spark, folder, tmp_path)[0].count() == 2
    finally:
        spark.conf.set(key, before)


def test_broker_messages_decode_like_files(spark):
    """The broker's binary value and offset, without a broker."""
    from tapewatch.sources.trades import decode_trades, with_event_time
    lines = [(json.dumps({"symbol": "A", "price": float(i), "quantity": 1.0, "timestamp": BASE,
                          "is_buyer_maker": False}).encode(), 100 - i) for i in range(5)]
    messages = spark.createDataFrame(lines, "value binary, offset long").selectExpr("*", "3 AS partition")
    trades = with_event_time(decode_trades(messages, keep=["partition", "offset"]))
    row = window_stats(trades, order=windows.BROKER_ORDER).first()
    assert (row.price_first, row.price_last) == (4.0, 0.0)
    assert KafkaSource("host:9092", "trades").max_offsets_per_trigger == 10_000


def test_progress_without_state_is_empty(spark, folder, tmp_path):
    folder.add(("A", 1.0, 1))
    q = run.run_to_parquet(trade_stream(spark, folder.source).withColumn("x", F.lit(1)), str(tmp_path / "o"),
                           str(tmp_path / "c"), interval=None)
    q.awaitTermination()
    assert run.late_rows(q) == 0


def test_progress_log_outlives_what_a_query_remembers(spark, folder, tmp_path):
    for i in range(6):
        folder.add(("A", 1.0, i), ("A", 1.0, i + 1))
    key, log = "spark.sql.streaming.numRecentProgressUpdates", run.ProgressLog()
    before = spark.conf.get(key)
    spark.conf.set(key, "2")
    spark.streams.addListener(log)
    try:
        _, q = exact(spark, folder, tmp_path)
        for _ in range(50):
            if sum(n for _, n, _, _ in run.progress_rates(q, log)) == 12:
                break
            time.sleep(0.2)
        assert sum(n for _, n, _, _ in run.progress_rates(q, log)) == 12
        assert len(q.recentProgress) <= 2 and run.late_rows(q, log) == 0
    finally:
        spark.streams.removeListener(log)
        spark.conf.set(key, before)


# ---- open windows, progress of long runs, published batches -----------------------------------

def test_closed_and_open_windows_are_all_windows(spark, folder, tmp_path):
    for i in range(5):
        folder.add(*[(s, 100.0 + i + j, 25 * i + j) for j in range(5) for s in "AB"])
    for _ in range(2):  # also after a restart without new data
        streamed, _ = exact(spark, folder, tmp_path)
        held = state.open_windows(spark, str(tmp_path / "ck"))
        assert 0 < held.count() < streamed.count() + held.count()
        assert rows(streamed.unionByName(held)) == rows(window_stats(trade_batch(spark, folder.source)))
    folder.add(("A", 1.0, 10_000))
    streamed, _ = exact(spark, folder, tmp_path)
    assert state.open_windows(spark, str(tmp_path / "ck")).count() == 2


def test_open_windows_reach_training(spark, folder, tmp_path):
    for i in range(3):
        folder.add(("A", 1.0 + i, 40 * i), ("A", 2.0 + i, 40 * i + 1))
    path = lambda name: str(tmp_path / name)
    closed = flow.accumulate(spark, folder.source, path("a"), path("b"), 300, interval=None)
    every = flow.accumulate(spark, folder.source, path("a"), path("b"), 300, interval=None, still_open=True)
    batch = flow.features_of(trade_batch(spark, folder.source))
    assert closed.count() < every.count() == batch.count()
    assert sorted(map(str, every.select(*batch.columns).collect())) == sorted(map(str, batch.collect()))


def test_state_of_something_else_is_refused(spark, folder, tmp_path):
    folder.add(("A", 1.0, 1))
    live = trade_stream(spark, folder.source).groupBy("symbol").count()
    q = live.writeStream.outputMode("complete").format("noop").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination()
    with pytest.raises(ValueError):
        state.open_windows(spark, str(tmp_path / "ck"))


def fake_progress(query, run_id, batch, late=0):
    progress = SimpleNamespace(id=query, runId=run_id, name=None, batchId=batch, timestamp="2024-05-01T12:00:00.000Z", numInputRows=3,
                               batchDuration=5, stateOperators=[SimpleNamespace(numRowsDroppedByWatermark=late)],
                               sources=[SimpleNamespace(inputRowsPerSecond=1.5, processedRowsPerSecond=None)])
    return SimpleNamespace(progress=progress)


def test_memory_of_a_long_run_does_not_grow(spark, tmp_path):
    path = str(tmp_path / "progress")
    log, most = ProgressTable(spark, path, buffer=2_500), 0
    for batch in range(10_000):
        log.onQueryProgress(fake_progress("q", "one", batch, late=batch % 2))
        most = max(most, len(log.rows))
    query = SimpleNamespace(id="q", runId="one")
    assert most < 2_500 and not log.rows and len(log.totals) == 1
    assert read_progress(spark, path).count() == 10_000
    assert (log.input_rows(query), log.late_rows(query)) == (30_000, 5_000)
    # a restart does the last batch again; totals and table count it once
    again = ProgressTable(spark, path)
    assert (again.input_rows(query), again.late_rows(query)) == (30_000, 5_000)
    for batch in (9_999, 10_000):
        again.onQueryProgress(fake_progress("q", "two", batch, late=1))
    again.onQueryTerminated(SimpleNamespace(runId="two"))
    assert again.wait(SimpleNamespace(runId="two"), 0)
    assert (again.input_rows(query), again.late_rows(query)) == (30_003, 5_001)
    assert read_progress(spark, path).count() == 10_001


def test_progress_log_remembers_a_bounded_number_of_batches():
    log = run.ProgressLog()
    for batch in range(3 * run.REMEMBERED):
        event = fake_progress("q", "one", batch, late=1)
        event.progress.inputRowsPerSecond = event.progress.processedRowsPerSecond = 1.0
        log.onQueryProgress(event)
    assert len(log.rates["one"]) == run.REMEMBERED and log.late["one"] == 3 * run.REMEMBERED


WATCHED = """
import sys, json
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
from tapewatch.sources.trades import FileSource, trade_stream
from tapewatch.streaming import run, windows
from tapewatch.streaming.live import keep_newest, newest_trades, state_rows, stream_trades_in_windows
from tapewatch.streaming.progress import ProgressTable
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
         .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", "file://" + sys.argv[3])
         .config("spark.sql.shuffle.partitions", "2").getOrCreate())
log = ProgressTable(spark, sys.argv[4], buffer=3)
spark.streams.addListener(log)
live = windows.stream_window_stats(trade_stream(spark, FileSource(sys.argv[2], max_files_per_trigger=1)))
q = run.run_to_parquet(live, sys.argv[4] + "-out", sys.argv[4] + "-ck", interval=None)
q.awaitTermination()
assert log.wait(q)
spark.stop()
"""


def test_progress_table_equals_the_event_log(spark, folder, tmp_path):
    folder.add(("A", 1.0, 70)).add(("A", 2.0, 125)).add(("A", 2.0, 126)).add(("A", 9.0, 75)).add(("A", 3.0, 300))
    logs, path = tmp_path / "logs", str(tmp_path / "progress")
    logs.mkdir()
    subprocess.run([sys.executable, "-c", WATCHED, os.path.dirname(os.path.dirname(os.path.abspath(__file__))), str(folder.path), str(logs), path],
                   check=True, timeout=300, capture_output=True)
    columns = ["batch_id", "input_rows", "batch_duration_ms", "late_rows"]
    logged = runmetrics.stream_progress(runmetrics.read_event_log(spark, str(logs)))
    table = read_progress(spark, path)
    assert sorted(map(tuple, table.select(columns).collect())) == sorted(map(tuple, logged.select(columns).collect()))
    rates = lambda df: sorted((r[0], round(r[1], 6), round(r[2], 6)) for r in df.select("batch_id", "input_rate", "processing_rate").collect())
    assert rates(table) == rates(logged)
    assert table.agg(F.sum("late_rows")).first()[0] >= 1


def test_readers_see_a_retried_batch_whole(spark, tmp_path):
    path, seen, stop = str(tmp_path / "t"), [], threading.Event()
    published.publish_batch(spark.range(5), path, 0)
    published.publish_batch(spark.range(7), path, 1)
    before = published.read_published(spark, path)

    def read():
        while not stop.is_set():
            seen.append(published.read_published(spark, path).filter("batch_id = 1").count())
    reader = threading.Thread(target=read)
    reader.start()
    for _ in range(4):
        published.publish_batch(spark.range(9), path, 1)
        published.publish_batch(spark.range(7), path, 1)
    stop.set()
    reader.join()
    assert seen and set(seen) <= {7, 9}
    assert before.count() == 12 == published.read_published(spark, path).count()


def test_a_batch_without_commit_is_not_there(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(ValueError):
        published.read_published(spark, path)
    spark.range(3).write.parquet(f"{path}/batch_id=0/died")
    assert published.commits(spark, path) == []
    published.publish_batch(spark.range(2), path, 0)
    assert published.read_published(spark, path).count() == 2
    assert published.vacuum(spark, path) == []  # too young
    assert published.vacuum(spark, path, older_than=0) == ["batch_id=0/died"]
    assert published.read_published(spark, path).count() == 2


def test_compaction_keeps_batches_and_readers(spark, tmp_path):
    path = str(tmp_path / "t")
    for batch in range(6):
        published.publish_batch(spark.range(batch + 1), path, batch)
    count = lambda: {r[0]: r[1] for r in published.read_published(spark, path).groupBy("batch_id").count().collect()}
    want, reader = {b: b + 1 for b in range(6)}, published.read_published(spark, path)
    assert published.compact_published(spark, path) is not None and count() == want
    assert [(c.first, c.last) for c in published.commits(spark, path)] == [(0, 4), (5, 5)]
    published.publish_batch(spark.range(60), path, 5)  # the last batch is retried
    published.publish_batch(spark.range(7), path, 6)
    assert count() == want | {5: 60, 6: 7}
    assert reader.count() == 21
    published.compact_published(spark, path)
    assert len(published.commits(spark, path)) == 2 and count() == want | {5: 60, 6: 7}
    assert len(published.vacuum(spark, path, older_than=0)) == 8 and count() == want | {5: 60, 6: 7}
    assert published.compact_published(spark, path, leave=2) is None


def test_no_job_reads_back_what_was_published(spark, tmp_path):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("publish", "one batch")
    try:
        published.publish_batch(spark.range(5), str(tmp_path / "t"), 0)
        assert len(tracker.getJobIdsForGroup("publish")) == 1
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


# ---- live views -------------------------------------------------------------------------------

def placed_rows(df):
    return sorted((r.symbol, r.event_time, r.price, r.window_start, r.window_end, r.prediction) for r in df.collect())


@pytest.mark.parametrize("size, slide", [("1 minute", "30 seconds"), ("50 seconds", "20 seconds")])
def test_trades_meet_predictions_live(spark, folder, tmp_path, size, slide):
    told = tmp_path / "told"
    schema = "symbol string, window_start timestamp, window_end timestamp, prediction double, probability double"
    for i in range(6):
        folder.add(*[(s, float(i), 60 * i + t) for t in range(0, 60, 7) for s in "AB"])
    trades = trade_batch(spark, folder.source)
    every = window_stats(trades, size, slide).select(
        "symbol", "window_start", "window_end", (F.col("trade_count") % 2).cast("double").alias("prediction"), F.lit(0.5).alias("probability"))
    every = every.filter("symbol = 'A'").cache()  # B has no predictions
    end = F.unix_millis("window_end") - BASE
    for i in range(8):  # the predictions of a step come one step later
        part = every.filter((end > 60_000 * (i - 1)) & (end <= 60_000 * i)).coalesce(1)
        part.write.mode("append").parquet(str(told))
        time.sleep(0.05)
    live = trade_stream(spark, folder.source)
    predictions = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(told))
    out = str(tmp_path / "joined")
    q = run.run_to_parquet(stream_trades_in_windows(live, predictions, size, slide), out, str(tmp_path / "ck"), interval=None)
    q.awaitTermination()
    assert placed_rows(spark.read.parquet(out)) == placed_rows(trades_in_windows(trades, every, size, slide))
    # 108 trades in two or three windows each went in; only those near the watermark are left
    assert 0 < state_rows(q) < 150


def newest_rows(df):
    return sorted((str(r.symbol), r.event_time, r.price, r.id) for r in df.collect())


def test_newest_trades_after_each_batch_and_a_restart(spark, tmp_path):
    rnd = random.Random(4)
    schema = "symbol string, event_time timestamp, price double, id long"
    order, inbox, ck, seen = ArrivalOrder("event_time", ("id",)), str(tmp_path / "in"), str(tmp_path / "ck"), []
    for batch in range(5):
        part = [("HOT" if rnd.random() < 0.7 else rnd.choice(["A", "B", None]),
                 datetime.fromtimestamp(BASE / 1000 + rnd.randrange(300), timezone.utc).replace(tzinfo=None), rnd.random(),
                 None if rnd.random() < 0.1 else batch * 1000 + i) for i in range(rnd.choice([3, 200]))]
        seen += part
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(inbox)
        live = spark.readStream.schema(schema).parquet(inbox)
        q = (keep_newest(live, 10, order, salts=3).writeStream.outputMode("update").format("noop")
             .option("checkpointLocation", ck).trigger(availableNow=True).start())  # each batch is a restart too
        q.awaitTermination()
        want = last_n_per_symbol(spark.createDataFrame(seen, schema), 10, order)
        got = newest_rows(newest_trades(spark, ck, 10, order).fillna(-1, ["id"]))
        assert got == newest_rows(want.fillna(-1, ["id"]))
    state = spark.read.format("statestore").option("stateVarName", "newest").load(ck)
    assert max(r["count"] for r in state.groupBy("key").count().collect()) <= 20


def test_idle_symbols_are_forgotten(spark, folder, tmp_path):
    ck = str(tmp_path / "ck")
    folder.add(("A", 1.0, 0), ("B", 1.0, 0)).add(("B", 2.0, 100)).add(("B", 3.0, 400)).add(("B", 4.0, 401))
    q = (keep_newest(trade_stream(spark, folder.source), 5, salts=1, idle="2 minutes").writeStream.outputMode("update").format("noop")
         .option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination()
    kept = {(r.symbol, r.price) for r in newest_trades(spark, ck, 5).collect()}
    assert ("A", 1.0) not in kept and {("B", 3.0), ("B", 4.0)} <= kept
