"""Run metrics from Spark event logs: what a run cost, and how runs compare.

Logs are read as JSON lines under an explicit schema, plain or compressed, of one file or of numbered
parts. A run is named by the log it came from.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewatch.functions.frames import union_loose
from tapewatch.functions.scalars import once
from tapewatch.sources.eventlogs import event_log_lines

EVENT_LOG_SCHEMA = """
    `Event` string,
    `Job ID` long, `Submission Time` long, `Completion Time` long, `Job Result` struct<`Result`: string>,
    `Stage ID` long, `Stage Attempt ID` long,
    `Stage Info` struct<`Stage ID`: long, `Stage Attempt ID`: long, `Number of Tasks`: long>,
    `Task Info` struct<`Task ID`: long, `Launch Time`: long, `Finish Time`: long,
        `Getting Result Time`: long, `Executor ID`: string, `Failed`: boolean>,
    `Task Metrics` struct<`Executor Deserialize Time`: long, `Executor Run Time`: long,
        `JVM GC Time`: long, `Result Serialization Time`: long,
        `Memory Bytes Spilled`: long, `Disk Bytes Spilled`: long,
        `Shuffle Read Metrics`: struct<`Remote Bytes Read`: long, `Local Bytes Read`: long>,
        `Shuffle Write Metrics`: struct<`Shuffle Bytes Written`: long>,
        `Input Metrics`: struct<`Bytes Read`: long>, `Output Metrics`: struct<`Bytes Written`: long>>,
    `Executor ID` string, `Executor Info` struct<`Host`: string, `Total Cores`: int>,
    `Block Manager ID` struct<`Executor ID`: string>, `Maximum Memory` long,
    `App ID` string, `App Name` string, `Timestamp` long,
    `Spark Properties` map<string, string>,
    `progress` struct<`name`: string, `runId`: string, `timestamp`: string, `batchId`: long,
        `batchDuration`: long,
        `sources`: array<struct<`numInputRows`: long, `inputRowsPerSecond`: double,
            `processedRowsPerSecond`: double>>,
        `stateOperators`: array<struct<`numRowsTotal`: long, `numRowsDroppedByWatermark`: long>>>
"""

# Fixed value: the event name Spark writes for streaming progress.
_PROGRESS = "org.apache.spark.sql.streaming.StreamingQueryListener$QueryProgressEvent"


def parse_events(lines: DataFrame, column: str = "value", run: str = "run", bad: str | None = None) -> DataFrame:
    """JSON lines with a run column to typed events, each line parsed once. ``bad`` names a column that takes the lines
    that could not be read in full."""
    schema, options = (f"{EVENT_LOG_SCHEMA}, `{bad}` string", {"columnNameOfCorruptRecord": bad}) if bad else (EVENT_LOG_SCHEMA, {})
    return lines.select(run, once(F.from_json(column, schema, options)).alias("e")).select(run, "e.*")


def read_event_log(spark: SparkSession, path: str | list[str], run: str | None = None) -> DataFrame:
    """Typed events of one log or several, as Spark writes them by default or otherwise. ``run`` names the run, e.g.
    after its machine; by default each log is a run of its own, named by its application. A line that
    was cut off has no event and counts nowhere."""
    lines = event_log_lines(spark, path)
    events = parse_events(lines if run is None else lines.withColumn("run", F.lit(run)), bad="_bad")
    # what a line cut off before a value holds up to there is read as an event; a whole line with an odd value is one
    whole = F.col("_bad").isNull() | F.try_parse_json("_bad").isNotNull()
    return events.filter(F.col("Event").isNotNull() & whole).drop("_bad")


def _of(events: DataFrame, kind: str) -> DataFrame:
    return events.filter(F.col("Event") == kind)


def _mb(size: Column | str) -> Column:
    return F.round((F.col(size) if isinstance(size, str) else size) / F.lit(1024 * 1024), 2)


def job_summary(events: DataFrame) -> DataFrame:
    """Jobs, succeeded jobs and the summed duration of the succeeded, per run."""
    jobs = (events.filter(F.col("Event").isin("SparkListenerJobStart", "SparkListenerJobEnd"))
            .groupBy("run", F.col("Job ID").alias("job"))
            .agg(F.max("Submission Time").alias("start"), F.max("Completion Time").alias("end"),
                 F.max(F.col("Job Result.Result") == "JobSucceeded").alias("done")))
    took = F.when(F.col("done"), F.col("end") - F.col("start"))
    return jobs.groupBy("run").agg(
        F.count(F.lit(1)).alias("total_jobs"), F.count_if("done").alias("completed_jobs"),
        F.coalesce(F.sum(took), F.lit(0)).alias("total_job_duration_ms"))


def _task_columns() -> dict[str, Column]:
    """What a finished task cost; of use in task-end events only."""
    metrics, info = F.col("Task Metrics"), F.col("Task Info")
    read = metrics["Shuffle Read Metrics"]

    def ms(c: Column) -> Column:
        return F.coalesce(c, F.lit(0))

    launch, finish, fetch = info["Launch Time"], info["Finish Time"], info["Getting Result Time"]
    fetching = F.when(fetch > 0, finish - fetch).otherwise(0)
    waited = (finish - launch - ms(metrics["Executor Run Time"]) - ms(metrics["Executor Deserialize Time"])
              - ms(metrics["Result Serialization Time"]) - fetching)
    return {
        "executor_run_time_ms": ms(metrics["Executor Run Time"]),
        "gc_time_ms": ms(metrics["JVM GC Time"]),
        "shuffle_read_bytes": ms(read["Remote Bytes Read"]) + ms(read["Local Bytes Read"]),
        "shuffle_write_bytes": ms(metrics["Shuffle Write Metrics"]["Shuffle Bytes Written"]),
        "input_bytes": ms(metrics["Input Metrics"]["Bytes Read"]),
        "output_bytes": ms(metrics["Output Metrics"]["Bytes Written"]),
        "memory_bytes_spilled": ms(metrics["Memory Bytes Spilled"]),
        "disk_bytes_spilled": ms(metrics["Disk Bytes Spilled"]),
        "scheduler_delay_ms": F.greatest(waited, F.lit(0))}


def _task_ends(events: DataFrame) -> DataFrame:
    info = F.col("Task Info")
    return _of(events, "SparkListenerTaskEnd").select(
        "run", F.col("Stage ID").alias("stage_id"), F.col("Stage Attempt ID").alias("attempt"),
        info["Task ID"].alias("task_id"), info["Executor ID"].alias("executor_id"), info["Failed"].alias("failed"),
        *[c.alias(name) for name, c in _task_columns().items()])


_SUMMED = ["executor_run_time_ms", "gc_time_ms", "shuffle_read_bytes", "shuffle_write_bytes",
           "input_bytes", "output_bytes", "memory_bytes_spilled", "disk_bytes_spilled"]


def task_totals(events: DataFrame) -> DataFrame:
    """Run, collection, shuffle, I/O and spill totals per run; megabytes rounded to 2 places."""
    return _task_ends(events).groupBy("run").agg(*[F.sum(c).alias(c) for c in _SUMMED]).withColumns(_megabytes())


def _megabytes() -> dict[str, Column]:
    return {"shuffle_read_mb": _mb("shuffle_read_bytes"), "shuffle_write_mb": _mb("shuffle_write_bytes"),
            "memory_spill_mb": _mb("memory_bytes_spilled"), "disk_spill_mb": _mb("disk_bytes_spilled")}


def stage_counts(events: DataFrame) -> DataFrame:
    return _of(events, "SparkListenerStageCompleted").groupBy("run").agg(
        F.count(F.lit(1)).alias("total_stages"))


def scheduler_delay(events: DataFrame) -> DataFrame:
    """Waiting time of tasks per run and stage: sum, mean and maximum."""
    delay = F.col("scheduler_delay_ms")
    return _task_ends(events).groupBy("run", "stage_id", "attempt").agg(
        F.count(F.lit(1)).alias("tasks"), F.sum(delay).alias("scheduler_delay_ms"),
        F.avg(delay).alias("mean_delay_ms"), F.max(delay).alias("max_delay_ms"))


def _parts(events: DataFrame) -> DataFrame:
    """One pass over the events: what each executor, each job and the application of a run amount to."""
    kind = F.col("Event")
    task, job = kind == "SparkListenerTaskEnd", kind.isin("SparkListenerJobStart", "SparkListenerJobEnd")
    executor = (F.when(task, F.col("Task Info.Executor ID"))
                .when(kind == "SparkListenerBlockManagerAdded", F.col("Block Manager ID.Executor ID"))
                .when(kind == "SparkListenerExecutorAdded", F.col("Executor ID")))
    app = kind == "SparkListenerApplicationStart"
    columns = _task_columns()
    used = events.filter(executor.isNotNull() | job | app | (kind == "SparkListenerStageCompleted"))
    return used.groupBy("run", executor.alias("executor_id"), F.when(job, F.col("Job ID")).alias("job")).agg(
        *[F.sum(F.when(task, columns[c])).alias(c) for c in _SUMMED], F.count_if(task).alias("tasks"),
        F.max("Maximum Memory").alias("memory"), F.max("Executor Info.Total Cores").alias("cores"),
        F.max(F.when(job, F.col("Submission Time"))).alias("job_start"), F.max(F.when(job, F.col("Completion Time"))).alias("job_end"),
        F.max(F.col("Job Result.Result") == "JobSucceeded").alias("job_done"),
        F.count_if(kind == "SparkListenerStageCompleted").alias("stages"),
        F.max(F.when(app, F.col("App Name"))).alias("app_name"), F.min(F.when(app, F.col("Timestamp"))).alias("started_ms"))


def executor_totals(events: DataFrame) -> DataFrame:
    """Memory, cores, tasks and collection time per run and executor (the driver is one)."""
    return _parts(events).filter(F.col("executor_id").isNotNull()).select(
        "run", "executor_id", _mb("memory").alias("max_memory_mb"), "cores", F.col("tasks").alias("total_tasks"),
        F.coalesce("gc_time_ms", F.lit(0)).alias("total_gc_time_ms"))


def config_diff(events: DataFrame, runs: Sequence[str]) -> DataFrame:
    """Settings that differ between the runs: one row per key, one column per run."""
    settings = (_of(events, "SparkListenerEnvironmentUpdate")
                .select("run", F.explode("Spark Properties").alias("key", "value")))
    per_key = settings.groupBy("key").agg(
        *[F.max(F.when(F.col("run") == r, F.col("value"))).alias(r) for r in runs])
    first = F.col(f"`{runs[0]}`")
    differs = F.lit(False)
    for r in runs[1:]:
        differs = differs | ~first.eqNullSafe(F.col(f"`{r}`"))
    return per_key.filter(differs).orderBy("key")


def run_summary(events: DataFrame) -> DataFrame:
    """One row per run with every total, and the name of its application; a total without events is null."""
    driver, job = F.col("executor_id") == "driver", F.col("job").isNotNull()
    done = job & F.col("job_done")
    any_of = lambda n, value: F.when(n > 0, value)
    jobs, stages = F.count("job"), F.sum("stages")
    return _parts(events).groupBy("run").agg(
        F.max("app_name").alias("app_name"), F.min("started_ms").alias("started_ms"),
        any_of(jobs, jobs).alias("total_jobs"), any_of(jobs, F.count_if(done)).alias("completed_jobs"),
        any_of(jobs, F.coalesce(F.sum(F.when(done, F.col("job_end") - F.col("job_start"))), F.lit(0))).alias("total_job_duration_ms"),
        any_of(stages, stages).alias("total_stages"), *[F.sum(c).alias(c) for c in _SUMMED],
        _mb(F.max(F.when(driver, F.col("memory")))).alias("driver_max_memory_mb"),
        F.max(F.when(driver, F.coalesce("gc_time_ms", F.lit(0)))).alias("driver_total_gc_time_ms"),
        F.max(F.when(driver, F.col("tasks"))).alias("driver_total_tasks")).withColumns(_megabytes())


def consolidate_runs(*summaries: DataFrame) -> DataFrame:
    """All runs in one table; a total that a run lacks is null."""
    return union_loose(*summaries)


def compare_runs(runs: DataFrame, base: str, other: str, metrics: Sequence[str],
                 run: str = "run") -> DataFrame:
    """Metric by metric: base run, other run, difference and ratio (null when the base is 0)."""
    numbers = runs.filter(F.col(run).isin(base, other)).select(
        run, *[F.col(m).cast("double").alias(m) for m in metrics])
    long = numbers.unpivot([run], list(metrics), "metric", "value")
    sides = long.groupBy("metric").agg(
        F.max(F.when(F.col(run) == base, F.col("value"))).alias("base_value"),
        F.max(F.when(F.col(run) == other, F.col("value"))).alias("other_value"))
    return sides.withColumns({
        "difference": F.col("other_value") - F.col("base_value"),
        "ratio": F.try_divide("other_value", "base_value")})


def stream_progress(events: DataFrame) -> DataFrame:
    """Rows, rates, duration and late rows of every micro-batch in the logs."""
    p = F.col("progress")

    def total(field: str) -> Column:
        return F.aggregate(F.transform(p["sources"], lambda s: F.coalesce(s[field].cast("double"), F.lit(0.0))),
                           F.lit(0.0), lambda a, v: a + v)

    late = F.aggregate(F.transform(p["stateOperators"], lambda s: F.coalesce(s["numRowsDroppedByWatermark"], F.lit(0))),
                       F.lit(0).cast("long"), lambda a, v: a + v)
    return _of(events, _PROGRESS).select(
        "run", p["name"].alias("query"), p["runId"].alias("query_run"), p["batchId"].alias("batch_id"),
        p["timestamp"].alias("at"), total("numInputRows").cast("long").alias("input_rows"),
        total("inputRowsPerSecond").alias("input_rate"),
        total("processedRowsPerSecond").alias("processing_rate"),
        p["batchDuration"].alias("batch_duration_ms"), late.alias("late_rows"))
