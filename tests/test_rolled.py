"""Logs in parts: the files of a run stay spread, and every line is in one live part."""

from pyspark.sql import functions as F

from tapewatch.plans.catalog import QUERIES, runs
from tapewatch.session import deal
from tapewatch.sources.eventlogs import decode_parts, log_parts


def lines(spark, rows, names, tasks=8):
    """``rows`` lines over ``tasks`` tasks, dealt to the runs ``names`` and to a run without a name."""
    kinds = F.array(*[F.lit(n).cast("string") for n in [*names, None]])
    text = F.format_string('{"Event":"SparkListenerTaskEnd","Stage ID":%d}', F.col("id"))
    return spark.range(0, rows, 1, tasks).select(
        F.element_at(kinds, (F.col("id") % (len(names) + 1) + 1).cast("int")).alias("run"), text.alias("value"))


def tasks_of(frame):
    """In how many tasks the rows of each run are."""
    spread = frame.select("run", F.spark_partition_id().alias("task")).distinct().groupBy("run").count()
    return {r["run"]: r["count"] for r in spread.collect()}


def test_files_of_a_run_stay_spread(spark):
    name = F.concat(F.lit("log:/eventlog_v2_app/events_"), F.col("id") + 1, F.lit("_app"),
                    F.when(F.col("id") == 9, ".zstd.compact").otherwise(".zstd"))
    files = spark.range(0, 80, 1, 8).select(name.alias("path"), F.encode(F.lit("x"), "UTF-8").alias("content"))
    live = log_parts(files)
    assert live.columns == ["path", "content", "run", "part", "codec"]
    assert sorted(r["part"] for r in live.collect()) == list(range(10, 81))
    assert tasks_of(live) == {"app": 8}


def test_events_of_a_run_stay_spread(spark):
    assert min(tasks_of(runs._rolled_events(lines(spark, 8_000, ["A", "N"]))).values()) > 1


def test_parts_are_packed_where_the_lines_are(spark):
    told = lines(spark, 30_000, ["A"], 3)
    files = runs._log_files(told)
    plan = files._jdf.queryExecution().executedPlan().toString()
    assert not any(step in plan for step in ("Exchange", "Sort", "Window", "Aggregate"))
    parts = files.filter("path not like '%appstatus%'").collect()
    assert len({r["path"] for r in parts}) == len(parts)
    held = decode_parts(log_parts(files)).filter("value <> ''")
    assert held.groupBy("run", "part").count().agg(F.max("count")).first()[0] == runs._PART_LINES
    # a null name is written out in the name of a file
    told = told.select(F.coalesce("run", F.lit("None")).alias("run"), "value")
    back = held.select("run", "value")
    assert back.count() == 30_000 and back.exceptAll(told).count() == 0


def test_more_runs_than_open_parts(spark):
    told = lines(spark, 4_000, [f"app-{i}" for i in range(3 * runs._OPEN_PARTS)], 2)
    back = decode_parts(log_parts(runs._log_files(told))).filter("value <> ''")
    assert back.count() == 4_000 and back.select("value").exceptAll(told.select("value")).count() == 0


def test_jobs_of_one_row_group_are_dealt_out(spark, tmp_path):
    key = F.col("id")
    spark.range(0, 4_000, 1, 1).select(
        key.alias("o_orderkey"), (key % 7).alias("o_custkey"), F.lit("F").alias("o_orderstatus"),
        F.date_add(F.lit("1995-01-01").cast("date"), (key % 9).cast("int")).alias("o_orderdate")).write.parquet(str(tmp_path / "orders.parquet"))
    sf = str(tmp_path)
    files = runs._log_files(runs._job_lines(spark, sf, 8))
    assert files.select(F.spark_partition_id()).distinct().count() == 8
    (row,) = QUERIES["rolled_job_summary"](spark, sf).collect()
    assert tuple(row) == ("F", 4_000, 3_600, sum(k % 7 for k in range(4_000) if k % 10))


def test_totals_of_a_spread_run(spark, sf):
    events = runs._rolled_events(runs._task_lines(spark, sf))
    assert min(tasks_of(events).values()) > 1
    want = runs.M.task_totals(runs._task_events(spark, sf))
    got = runs.M.task_totals(events)
    assert got.count() == want.count() > 0 and got.exceptAll(want).count() == 0


def test_parts_of_a_union_have_names_of_their_own(spark):
    more = lines(spark, 5_000, ["A"], 3).withColumn("value", F.concat("value", F.lit(" ")))
    told = lines(spark, 9_000, ["A"], 4).unionByName(more)
    events = runs._rolled_events(told)
    assert events.count() == 14_000 and min(tasks_of(events).values()) > 1
    parts = runs._log_files(told).filter("path not like '%appstatus%'").select("path")
    assert parts.distinct().count() == parts.count()


def test_rows_become_lines_without_a_sort(spark, sf):
    # dealing rows out in turn sorts all that a task reads, a whole table if it is one row group
    for told in (runs._task_lines(spark, sf), runs._job_lines(spark, sf, 8)):
        plan = told._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(_row" in plan and "RoundRobin" not in plan


def test_equal_rows_are_dealt_evenly(spark):
    dealt = deal(spark.range(0, 8_000, 1, 1).select(F.lit("A").alias("run")), 8)
    assert dealt.columns == ["run"]
    spread = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(spread) == 8_000 and len(spread) == 8 and max(spread) < 2 * min(spread)


def test_rows_are_dealt_to_no_more_tasks_than_the_writer_streams_to(spark):
    # beyond that many Spark's shuffle writer holds all that a task reads, a whole table if it is one row group
    dealt = deal(spark.range(0, 8_000, 1, 1), 240)
    most = int(spark.conf.get("spark.shuffle.sort.bypassMergeThreshold", "200"))
    assert dealt.rdd.getNumPartitions() == most < 240
    assert dealt.distinct().count() == 8_000 and deal(spark.range(9), 8).rdd.getNumPartitions() == 8


def test_files_of_executors_are_made_without_a_sort(spark, sf):
    files = runs._log_files(runs._task_lines(spark, sf).unionByName(runs._hardware_lines(spark, sf)))
    plan = files._jdf.queryExecution().executedPlan().toString()
    assert not any(step in plan for step in ("RoundRobin", "Sort", "Aggregate"))
    want = runs.M.executor_totals(runs._task_events(spark, sf).unionByName(runs._hardware_events(spark, sf)))
    got = runs.M.executor_totals(runs.M.parse_events(decode_parts(log_parts(files))))
    assert got.count() == want.count() > 0 and got.exceptAll(want).count() == 0
