"""Run metrics over a real event log, written by a small separate Spark run."""

import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from tapewatch.operators import runmetrics as M
from tapewatch.plans import export

SCRIPT = """
import sys
from pyspark.sql import SparkSession, functions as F
spark = (SparkSession.builder.master("local[2]").appName("logged").config("spark.ui.enabled", "false")
         .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", "file://" + sys.argv[1])
         .config("spark.eventLog.compress", "false").config("spark.eventLog.rolling.enabled", "false")
         .config("spark.sql.shuffle.partitions", sys.argv[2]).getOrCreate())
spark.range(10000).groupBy((F.col("id") % 10).alias("g")).count().collect()
q = (spark.readStream.format("rate").option("rowsPerSecond", 50).load().writeStream.format("noop")
     .option("checkpointLocation", sys.argv[1] + "-checkpoint").start())
q.awaitTermination(5)
q.stop()
spark.stop()
"""


@pytest.fixture(scope="module")
def logs(tmp_path_factory):
    found = []
    for partitions in ("2", "3"):
        folder = tmp_path_factory.mktemp("log")
        subprocess.run([sys.executable, "-c", SCRIPT, str(folder), partitions], check=True, timeout=180,
                       capture_output=True)
        (log,) = [p for p in folder.iterdir() if p.is_file() and not p.name.startswith(".")]
        found.append(str(log))
    return found


@pytest.fixture(scope="module")
def events(spark, logs):
    return M.read_event_log(spark, logs[0])


def test_summary_of_one_run(events):
    row = M.run_summary(events).first()
    assert row.app_name == "logged" and row.total_jobs == row.completed_jobs > 0
    assert row.total_stages > 0 and row.executor_run_time_ms > 0 and row.shuffle_write_bytes > 0
    assert row.driver_total_tasks > 0 and row.driver_max_memory_mb > 0
    assert row.shuffle_read_mb == pytest.approx(row.shuffle_read_bytes / 1048576, abs=0.01)


def test_runs_can_be_named(spark, logs):
    assert M.run_summary(M.read_event_log(spark, logs[0], run="two-cores")).first().run == "two-cores"


def test_delay_is_not_negative(events):
    out = M.scheduler_delay(events)
    assert out.count() > 0 and out.filter("scheduler_delay_ms < 0").count() == 0


def test_executor_totals(events):
    row = M.executor_totals(events).first()
    assert row.executor_id == "driver" and row.cores == 2


def test_stream_progress(events):
    out = M.stream_progress(events)
    assert out.agg(F.sum("input_rows")).first()[0] > 0
    assert out.filter("batch_duration_ms is null or processing_rate is null").count() == 0


def test_two_runs(spark, logs, tmp_path):
    both = M.read_event_log(spark, logs)
    runs = sorted(r.run for r in both.select("run").distinct().collect())
    diff = {r["key"]: (r[runs[0]], r[runs[1]]) for r in M.config_diff(both, runs).collect()}
    assert set(diff["spark.sql.shuffle.partitions"]) == {"2", "3"}
    assert "spark.master" not in diff
    summary = M.run_summary(both)
    out = {r.metric: r for r in M.compare_runs(summary, runs[0], runs[1], ["total_jobs", "disk_spill_mb"]).collect()}
    assert out["total_jobs"].ratio == pytest.approx(out["total_jobs"].other_value / out["total_jobs"].base_value)
    assert out["disk_spill_mb"].ratio is None and out["disk_spill_mb"].difference == 0.0
    export.export_runs(spark, logs, str(tmp_path / "runs"))
    assert spark.read.option("header", True).csv(str(tmp_path / "runs")).count() == 2


def test_predictions_export(spark, sf, tmp_path):
    from pyspark.ml.functions import array_to_vector
    from tapewatch.plans.catalog.base import stats
    from tapewatch.sources.sinks import export_csv
    p = F.array(F.lit(0.25), F.lit(0.75))
    scored = stats(spark, sf).select("symbol", "window_start", F.lit(1.0).alias("prediction"),
                                     array_to_vector(p).alias("probability"))
    scored.write.parquet(str(tmp_path / "scored"))
    assert export.export_predictions(spark, str(tmp_path / "scored"), str(tmp_path / "csv"))
    row = spark.read.option("header", True).csv(str(tmp_path / "csv")).first()
    assert (row.prob_normal, row.prob_anomalo, row.label_predicted) == ("0.25", "0.75", "anomalo")
    export_csv(scored, str(tmp_path / "raw"))
    assert spark.read.option("header", True).csv(str(tmp_path / "raw")).first().probability == "[0.25,0.75]"


def test_exports_fall_back_and_skip(spark, sf, tmp_path):
    from tapewatch.plans.catalog.base import stats
    accumulating = str(tmp_path / "accumulating")
    stats(spark, sf).write.parquet(accumulating)
    assert export.export_windows(spark, [str(tmp_path / "final"), accumulating], str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == stats(spark, sf).count()
    assert not export.export_windows(spark, [str(tmp_path / "final")], str(tmp_path / "csv2"))
    assert not export.export_predictions(spark, str(tmp_path / "final"), str(tmp_path / "csv3"))


# ---- logs as Spark writes them by default -----------------------------------------------------

ROLLED = """
import sys
from pyspark.sql import SparkSession, functions as F
spark = (SparkSession.builder.master("local[4]").appName("rolled").config("spark.ui.enabled", "false")
         .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", "file://" + sys.argv[1])
         .config("spark.eventLog.rolling.maxFileSize", "10m").config("spark.sql.shuffle.partitions", "4"))
for setting in sys.argv[2:]:
    spark = spark.config(*setting.split("=", 1))
spark = spark.getOrCreate()
spark.range(0, 10000, 1, 100).groupBy((F.col("id") % 10).alias("g")).count().collect()
if len(sys.argv) == 2:
    for _ in range(3):
        spark.sparkContext.parallelize(range(2500), 2500).map(lambda x: x).count()
spark.stop()
"""


def write_log(folder, *settings):
    subprocess.run([sys.executable, "-c", ROLLED, str(folder), *settings], check=True, timeout=300, capture_output=True)


@pytest.fixture(scope="module")
def rolled(tmp_path_factory):
    """One run under default settings, rolled several times, and the same lines as one plain file."""
    import zstandard
    folder, plain = tmp_path_factory.mktemp("rolled"), tmp_path_factory.mktemp("plain")
    write_log(folder)
    (app,) = folder.iterdir()
    parts = sorted((p for p in app.iterdir() if p.name.startswith("events_")), key=lambda p: int(p.name.split("_")[1]))
    texts = [zstandard.ZstdDecompressor().stream_reader(p.read_bytes(), read_across_frames=True).read() for p in parts]
    (plain / app.name.removeprefix("eventlog_v2_")).write_bytes(b"".join(texts))
    return app, parts, texts, plain


def tables(events):
    runs = [r.run for r in events.select("run").distinct().collect()]
    out = [M.job_summary(events), M.task_totals(events), M.scheduler_delay(events), M.executor_totals(events), M.run_summary(events)]
    return [runs, *[sorted(map(str, t.collect())) for t in out]]


def test_default_logs_give_the_tables_of_plain_ones(spark, rolled):
    app, parts, _, plain = rolled
    assert len(parts) >= 3 and all(p.suffix == ".zstd" for p in parts)
    want = tables(M.read_event_log(spark, str(plain)))
    assert want[0] == [app.name.removeprefix("eventlog_v2_")]
    assert tables(M.read_event_log(spark, str(app))) == tables(M.read_event_log(spark, str(app.parent))) == want


def test_compacted_parts_replace_those_before(spark, rolled, tmp_path):
    app, parts, texts, plain = rolled
    folder = tmp_path / app.name
    folder.mkdir()
    for p in parts:
        (folder / p.name).write_bytes(p.read_bytes())
    run = app.name.removeprefix("eventlog_v2_")
    # an older compacted part, and one that holds the first two parts in full; neither is to be counted with its sources
    (folder / f"events_1_{run}.compact").write_bytes(texts[0])
    (folder / f"events_2_{run}.compact").write_bytes(texts[0] + texts[1])
    (folder / f"appstatus_{run}.inprogress").touch()
    assert tables(M.read_event_log(spark, str(folder))) == tables(M.read_event_log(spark, str(plain)))


def test_the_unfinished_last_part(spark, rolled, tmp_path):
    app, parts, texts, _ = rolled
    cut, whole = tmp_path / "cut" / app.name, tmp_path / "whole"
    cut.mkdir(parents=True)
    whole.mkdir()
    for p in parts[:-1]:
        (cut / p.name).write_bytes(p.read_bytes())
    data = parts[-1].read_bytes()
    (cut / parts[-1].name).write_bytes(data[:len(data) * 2 // 3])
    import io
    import zstandard
    left = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data[:len(data) * 2 // 3]), read_across_frames=True).read()
    (whole / app.name.removeprefix("eventlog_v2_")).write_bytes(b"".join(texts[:-1]) + left[:left.rfind(b"\n") + 1])
    got = tables(M.read_event_log(spark, str(cut)))
    assert got == tables(M.read_event_log(spark, str(whole)))
    assert got != tables(M.read_event_log(spark, str(app)))


@pytest.mark.parametrize("codec, rolling", [("lz4", "false"), ("snappy", "true"), ("zstd", "false")])
def test_codecs(spark, tmp_path, codec, rolling):
    write_log(tmp_path, f"spark.eventLog.compression.codec={codec}", f"spark.eventLog.rolling.enabled={rolling}", "spark.eventLog.compress=true")
    events = M.read_event_log(spark, str(tmp_path))
    row = M.run_summary(events).first()
    assert row.app_name == "rolled" and row.total_jobs == row.completed_jobs > 0 and row.driver_total_tasks > 100
    assert events.select("run").distinct().count() == 1 and "." not in row.run


def test_nothing_to_read(spark, tmp_path):
    from tapewatch.sources.eventlogs import event_log_lines
    assert event_log_lines(spark, str(tmp_path)).count() == 0


def test_a_line_cut_anywhere_counts_nowhere(spark, tmp_path):
    line = ('{"Event":"SparkListenerTaskEnd","Stage ID":3,"Stage Attempt ID":0,"Task Info":{"Task ID":5,"Launch Time":100,'
            '"Finish Time":200,"Accumulables":[{"ID":1}]},"Task Metrics":{"Executor Run Time":50,"Updated Blocks":[]}}')
    odd = line.replace('"Stage ID":3', '"Stage ID":"three"')
    (tmp_path / "app").write_text("\n".join([odd, *[line[:n] for n in range(1, len(line) + 1)]]))
    events = M.read_event_log(spark, str(tmp_path / "app"))
    assert "_bad" not in events.columns
    assert sorted(map(str, events.select("Stage ID", "Task Metrics.Executor Run Time").collect())) == [
        "Row(Stage ID=3, Executor Run Time=50)", "Row(Stage ID=None, Executor Run Time=50)"]
