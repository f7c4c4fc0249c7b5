"""Run metrics over event-log lines. The lines are derived from lineitem (one finished task per
row; the return flag names the run) and orders (one job per row; the status names the run)."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapewatch.operators import runmetrics as M
from tapewatch.plans.catalog.base import query, table
from tapewatch.session import deal, parallelism, settle
from tapewatch.sources.eventlogs import decode_parts, log_parts


def _task_lines(spark, sf):
    q, day = F.col("l_quantity").cast("long"), F.unix_millis(F.col("l_shipdate").cast("timestamp"))
    line = F.to_json(F.struct(
        F.lit("SparkListenerTaskEnd").alias("Event"),
        F.col("l_linenumber").cast("long").alias("Stage ID"), F.lit(0).alias("Stage Attempt ID"),
        F.struct(F.col("l_orderkey").alias("Task ID"), day.alias("Launch Time"),
                 (day + q * 1000).alias("Finish Time"), F.lit(0).alias("Getting Result Time"),
                 F.when(F.col("l_suppkey") % 4 == 0, "driver")
                 .otherwise(F.concat(F.lit("exec-"), (F.col("l_suppkey") % 4).cast("string"))).alias("Executor ID"),
                 F.lit(False).alias("Failed")).alias("Task Info"),
        F.struct(q.alias("Executor Deserialize Time"), (q * 900).alias("Executor Run Time"),
                 F.col("l_linenumber").cast("long").alias("JVM GC Time"), F.lit(1).alias("Result Serialization Time"),
                 F.col("l_partkey").alias("Memory Bytes Spilled"), F.col("l_suppkey").alias("Disk Bytes Spilled"),
                 F.struct(F.col("l_partkey").alias("Remote Bytes Read"), F.col("l_suppkey").alias("Local Bytes Read"))
                 .alias("Shuffle Read Metrics"),
                 F.struct(F.col("l_orderkey").alias("Shuffle Bytes Written")).alias("Shuffle Write Metrics"),
                 F.struct((q * 10).alias("Bytes Read")).alias("Input Metrics"),
                 F.struct((q * 5).alias("Bytes Written")).alias("Output Metrics")).alias("Task Metrics")))
    # the table is one row group; its narrow rows are dealt out before they become wide lines
    rows = deal(table(spark, sf, "lineitem"), parallelism(spark))
    return rows.select(F.col("l_returnflag").alias("run"), line.alias("value"))


def _task_events(spark, sf):
    return M.parse_events(_task_lines(spark, sf))


def _job_lines(spark, sf, tasks=None):
    """A start and an end per order; ``tasks`` deals the narrow rows of a table of few row groups out beforehand."""
    at = F.unix_millis(F.col("o_orderdate").cast("timestamp"))
    start = F.to_json(F.struct(F.lit("SparkListenerJobStart").alias("Event"), F.col("o_orderkey").alias("Job ID"),
                               at.alias("Submission Time")))
    result = F.when(F.col("o_orderkey") % 10 == 0, "JobFailed").otherwise("JobSucceeded")
    end = F.to_json(F.struct(F.lit("SparkListenerJobEnd").alias("Event"), F.col("o_orderkey").alias("Job ID"),
                             (at + F.col("o_custkey")).alias("Completion Time"),
                             F.struct(result.alias("Result")).alias("Job Result")))
    orders = table(spark, sf, "orders")
    return (deal(orders, tasks) if tasks else orders).select(
        F.col("o_orderstatus").alias("run"), F.explode(F.array(start, end)).alias("value"))


def _job_events(spark, sf):
    return M.parse_events(_job_lines(spark, sf))


TOTALS_SQL = """totals AS (SELECT l_returnflag AS run, sum(l_quantity::BIGINT * 900)::BIGINT AS executor_run_time_ms,
  sum(l_linenumber)::BIGINT AS gc_time_ms, sum(l_partkey + l_suppkey)::BIGINT AS shuffle_read_bytes,
  sum(l_orderkey)::BIGINT AS shuffle_write_bytes, sum(l_quantity::BIGINT * 10)::BIGINT AS input_bytes,
  sum(l_quantity::BIGINT * 5)::BIGINT AS output_bytes, sum(l_partkey)::BIGINT AS memory_bytes_spilled,
  sum(l_suppkey)::BIGINT AS disk_bytes_spilled FROM lineitem GROUP BY 1),
task_totals AS (SELECT *, round(shuffle_read_bytes / 1048576.0::DOUBLE, 2) AS shuffle_read_mb,
  round(shuffle_write_bytes / 1048576.0::DOUBLE, 2) AS shuffle_write_mb,
  round(memory_bytes_spilled / 1048576.0::DOUBLE, 2) AS memory_spill_mb,
  round(disk_bytes_spilled / 1048576.0::DOUBLE, 2) AS disk_spill_mb FROM totals)"""
JOBS_SQL = """jobs AS (SELECT o_orderstatus AS run, count(*) AS total_jobs,
  count(*) FILTER (WHERE o_orderkey % 10 <> 0) AS completed_jobs,
  coalesce(sum(o_custkey) FILTER (WHERE o_orderkey % 10 <> 0), 0)::BIGINT AS total_job_duration_ms
FROM orders GROUP BY 1)"""


@query("job_summary", f"WITH {JOBS_SQL} SELECT * FROM jobs")
def _(spark, sf):
    return M.job_summary(_job_events(spark, sf))


@query("task_totals", f"WITH {TOTALS_SQL} SELECT * FROM task_totals")
def _(spark, sf):
    return M.task_totals(_task_events(spark, sf))


DELAY_SQL = """SELECT l_returnflag AS run, l_linenumber::BIGINT AS stage_id, 0::BIGINT AS attempt, count(*) AS tasks,
  sum(d)::BIGINT AS scheduler_delay_ms, round(avg(d), 6) AS mean_delay_ms, max(d)::BIGINT AS max_delay_ms
FROM (SELECT *, greatest(l_quantity::BIGINT * 99 - 1, 0) AS d FROM lineitem) GROUP BY 1, 2"""


@query("scheduler_delay", DELAY_SQL)
def _(spark, sf):
    return M.scheduler_delay(_task_events(spark, sf))


def _hardware_lines(spark, sf):
    """Memory, cores and finished stages: a line of each kind per supplier, its key names run and executor."""
    key = F.col("s_suppkey")
    run = F.element_at(F.array(F.lit("A"), F.lit("N"), F.lit("R")), (key % 3 + 1).cast("int"))
    executor = F.when(key % 5 == 0, "driver").otherwise(F.concat(F.lit("exec-"), (key % 5).cast("string")))
    memory = F.to_json(F.struct(F.lit("SparkListenerBlockManagerAdded").alias("Event"),
                                F.struct(executor.alias("Executor ID")).alias("Block Manager ID"),
                                (key * 1048576).alias("Maximum Memory")))
    cores = F.to_json(F.struct(F.lit("SparkListenerExecutorAdded").alias("Event"), executor.alias("Executor ID"),
                               F.struct((key % 16).alias("Total Cores")).alias("Executor Info")))
    stage = F.to_json(F.struct(F.lit("SparkListenerStageCompleted").alias("Event"),
                               F.struct(key.alias("Stage ID")).alias("Stage Info")))
    return table(spark, sf, "supplier").select(run.alias("run"), F.explode(F.array(memory, cores, stage)).alias("value"))


def _hardware_events(spark, sf):
    return M.parse_events(_hardware_lines(spark, sf))


def _app_events(spark, sf):
    apps = table(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("run")).agg(F.min("l_orderkey").alias("at"))
    line = F.to_json(F.struct(F.lit("SparkListenerApplicationStart").alias("Event"),
                              F.concat(F.lit("app-"), "run").alias("App Name"), F.col("at").alias("Timestamp")))
    return M.parse_events(apps.select("run", line.alias("value")))


HARDWARE_SQL = """hw AS (SELECT ['A', 'N', 'R'][1 + s_suppkey % 3] AS run,
  CASE WHEN s_suppkey % 5 = 0 THEN 'driver' ELSE 'exec-' || (s_suppkey % 5) END AS executor_id,
  round(max(s_suppkey)::DOUBLE, 2) AS max_memory_mb, max(s_suppkey % 16)::INTEGER AS cores, count(*) AS stages
  FROM supplier GROUP BY ALL),
by_executor AS (SELECT l_returnflag AS run,
  CASE WHEN l_suppkey % 4 = 0 THEN 'driver' ELSE 'exec-' || (l_suppkey % 4) END AS executor_id,
  count(*) AS total_tasks, sum(l_linenumber)::BIGINT AS total_gc_time_ms FROM lineitem GROUP BY 1, 2),
executors AS (SELECT run, executor_id, max_memory_mb, cores, coalesce(total_tasks, 0) AS total_tasks,
  coalesce(total_gc_time_ms, 0) AS total_gc_time_ms FROM hw FULL JOIN by_executor USING (run, executor_id))"""


@query("executor_totals", f"WITH {HARDWARE_SQL} SELECT * FROM executors")
def _(spark, sf):
    return M.executor_totals(_task_events(spark, sf).unionByName(_hardware_events(spark, sf)))


@query("run_summary", f"""WITH {TOTALS_SQL}, {JOBS_SQL}, {HARDWARE_SQL},
named AS (SELECT translate(run, 'FOP', 'ANR') AS run, total_jobs, completed_jobs, total_job_duration_ms FROM jobs),
apps AS (SELECT l_returnflag AS run, 'app-' || l_returnflag AS app_name, min(l_orderkey) AS started_ms FROM lineitem GROUP BY ALL),
stages AS (SELECT run, sum(stages)::BIGINT AS total_stages FROM hw GROUP BY 1),
drivers AS (SELECT run, max_memory_mb AS driver_max_memory_mb, total_gc_time_ms AS driver_total_gc_time_ms,
  total_tasks AS driver_total_tasks FROM executors WHERE executor_id = 'driver')
SELECT * FROM apps LEFT JOIN named USING (run) LEFT JOIN stages USING (run) LEFT JOIN task_totals USING (run)
LEFT JOIN drivers USING (run)""")
def _(spark, sf):
    jobs = _job_events(spark, sf).withColumn("run", F.translate("run", "FOP", "ANR"))
    events = _task_events(spark, sf)
    for more in (jobs, _hardware_events(spark, sf), _app_events(spark, sf)):
        events = events.unionByName(more)
    return M.run_summary(events)


CONFIG_SQL = """WITH kv AS (SELECT l_suppkey % 50 AS k, l_returnflag AS run,
  CASE WHEN l_suppkey % 50 % 3 = 0 THEN 'same' ELSE (sum(l_quantity)::BIGINT % 7)::VARCHAR END AS value
  FROM lineitem GROUP BY l_suppkey % 50, l_returnflag HAVING (l_suppkey % 50 + ascii(l_returnflag)) % 5 <> 0),
wide AS (SELECT 'supplier.' || k AS key, max(value) FILTER (WHERE run = 'A') AS A, max(value) FILTER (WHERE run = 'N') AS N,
  max(value) FILTER (WHERE run = 'R') AS R FROM kv GROUP BY 1)
SELECT * FROM wide WHERE A IS DISTINCT FROM N OR A IS DISTINCT FROM R"""


# Settings that agree, that differ, and that a run lacks.
def _setting_lines(spark, sf):
    k = F.col("l_suppkey") % 50
    settings = (table(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("run"), k.alias("k"))
                .agg(F.sum("l_quantity").cast("long").alias("q"))
                .filter((F.col("k") + F.ascii("run")) % 5 != 0))
    value = F.when(F.col("k") % 3 == 0, "same").otherwise((F.col("q") % 7).cast("string"))
    line = F.to_json(F.struct(F.lit("SparkListenerEnvironmentUpdate").alias("Event"),
                              F.create_map(F.concat(F.lit("supplier."), "k"), value).alias("Spark Properties")))
    return settings.select("run", line.alias("value"))


@query("config_diff", CONFIG_SQL)
def _(spark, sf):
    return M.config_diff(M.parse_events(_setting_lines(spark, sf)), ["A", "N", "R"])


@query("consolidate_runs", f"""WITH {TOTALS_SQL}, {JOBS_SQL}
SELECT run, total_jobs, total_job_duration_ms, NULL::BIGINT AS executor_run_time_ms, NULL::DOUBLE AS shuffle_read_mb FROM jobs
UNION ALL SELECT run, NULL, NULL, executor_run_time_ms, shuffle_read_mb FROM task_totals""")
def _(spark, sf):
    jobs = M.job_summary(_job_events(spark, sf)).drop("completed_jobs")
    tasks = M.task_totals(_task_events(spark, sf)).select("run", "executor_run_time_ms", "shuffle_read_mb")
    return M.consolidate_runs(jobs, tasks)


_COMPARED = ["executor_run_time_ms", "gc_time_ms", "shuffle_read_mb"]


@query("compare_runs", f"WITH {TOTALS_SQL} " + " UNION ALL ".join(
    f"""SELECT '{m}' AS metric, a.{m}::DOUBLE AS base_value, b.{m}::DOUBLE AS other_value,
  round(b.{m}::DOUBLE - a.{m}::DOUBLE, 6) AS difference, round(b.{m}::DOUBLE / a.{m}::DOUBLE, 6) AS ratio
  FROM task_totals a, task_totals b WHERE a.run = 'A' AND b.run = 'R'""" for m in _COMPARED))
def _(spark, sf):
    return M.compare_runs(M.task_totals(_task_events(spark, sf)), "A", "R", _COMPARED)


@query("stream_progress", """SELECT event_type AS run, event_id AS batch_id, user_id AS input_rows,
  round(value, 6) AS input_rate, round(value * 2, 6) AS processing_rate, user_id AS batch_duration_ms,
  event_id % 5 AS late_rows FROM events""")
def _(spark, sf):
    source = F.struct(F.col("user_id").alias("numInputRows"), F.col("value").alias("inputRowsPerSecond"),
                      (F.col("value") * 2).alias("processedRowsPerSecond"))
    line = F.to_json(F.struct(
        F.lit("org.apache.spark.sql.streaming.StreamingQueryListener$QueryProgressEvent").alias("Event"),
        F.struct(F.col("event_id").alias("batchId"), F.col("user_id").alias("batchDuration"),
                 F.array(source).alias("sources"),
                 F.array(F.struct((F.col("event_id") % 5).alias("numRowsDroppedByWatermark"))).alias("stateOperators"))
        .alias("progress")))
    events = M.parse_events(table(spark, sf, "events").select(F.col("event_type").alias("run"), line.alias("value")))
    return M.stream_progress(events).drop("query", "query_run", "at")


# ---- the same lines as logs that were rolled, compressed and compacted -------------------------

#: lines of a part; a run has as many parts as its lines need
_PART_LINES = 2_000
#: runs whose next part a task may have open
_OPEN_PARTS = 16
#: files differ in size by some hundred times, so pages and groups of rows are cut by bytes before they hold many
_FILE_OPTIONS = {"compression": "zstd", "parquet.block.size": 16 << 20, "parquet.block.size.row.check.min": 4,
                 "parquet.page.size.row.check.min": 4}


def _log_files(lines: DataFrame) -> DataFrame:
    """``path, content``: the lines of each run as numbered zstd parts of a folder, some of them merged into a compacted
    part beside the originals. A task packs the lines it has as they come, so none are sorted or moved."""
    def files(run: str | None, task: int, turn: int, held: list[str]) -> pa.RecordBatch:
        import zstandard
        # pairs of task and turn have numbers of their own, whatever the number of tasks
        part = (task + turn) * (task + turn + 1) // 2 + turn + 1
        name = f"eventlog_v2_{run}/events_{part}_{run}"
        data = "".join(x + "\n" for x in held).encode()
        packed = zstandard.compress(data)
        # part 1 is replaced by a compacted one of its lines, what it left behind is stale; plain parts do occur
        found = ([(f"{name}.zstd.compact", packed), (f"{name}.zstd", zstandard.compress(data + data))] if part == 1
                 else [(name, data)] if part % 3 == 0 else [(f"{name}.zstd", packed)])
        found.append((f"eventlog_v2_{run}/appstatus_{run}", b""))
        return pa.record_batch([pa.array(["log:/" + p for p, _ in found]), pa.array([c for _, c in found], pa.binary())],
                               ["path", "content"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, held, turns = TaskContext.get().partitionId(), {}, Counter()

        def close(run: str | None) -> pa.RecordBatch:
            turns[run] += 1
            return files(run, task, turns[run] - 1, held.pop(run))

        for batch in batches:
            for run, line in zip(*[batch.column(i).to_pylist() for i in range(2)]):
                if run not in held and len(held) == _OPEN_PARTS:
                    yield close(max(held, key=lambda r: len(held[r])))
                held.setdefault(run, []).append(line)
                if len(held[run]) == _PART_LINES:
                    yield close(run)
        for run in list(held):
            yield close(run)

    return lines.select("run", "value").mapInArrow(pack, "path string, content binary")


def _rolled_events(lines: DataFrame) -> DataFrame:
    """The lines of each run, written once as log files and read back through names and codec."""
    return M.parse_events(decode_parts(log_parts(settle(_log_files(lines), "log_files", **_FILE_OPTIONS))))


@query("rolled_job_summary", f"WITH {JOBS_SQL} SELECT * FROM jobs")
def _(spark, sf):
    return M.job_summary(_rolled_events(_job_lines(spark, sf, parallelism(spark))))


@query("rolled_task_totals", f"WITH {TOTALS_SQL} SELECT * FROM task_totals")
def _(spark, sf):
    return M.task_totals(_rolled_events(_task_lines(spark, sf)))


@query("rolled_scheduler_delay", DELAY_SQL)
def _(spark, sf):
    return M.scheduler_delay(_rolled_events(_task_lines(spark, sf)))


@query("rolled_executor_totals", f"WITH {HARDWARE_SQL} SELECT * FROM executors")
def _(spark, sf):
    return M.executor_totals(_rolled_events(_task_lines(spark, sf).unionByName(_hardware_lines(spark, sf))))


@query("rolled_config_diff", CONFIG_SQL)
def _(spark, sf):
    return M.config_diff(_rolled_events(_setting_lines(spark, sf)), ["A", "N", "R"])
