"""Shared-storage helpers: where to settle an intermediate result, and how."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_local_scratch: dict[str, str] = {}


def utc(spark: SparkSession) -> SparkSession:
    """Pin the session time zone; window bounds and timestamp texts are all UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A temporary folder is used only for a local session that names none.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _local_scratch:
        _local_scratch[context.applicationId] = tempfile.mkdtemp(prefix="tapewatch-")
    return _local_scratch[context.applicationId]


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str = "settled", **options: str | int) -> DataFrame:
    """Write ``df`` once to shared storage, with the writer's ``options``, and read it back.

    The result survives lost executors, has no lineage, and carries its true size, so
    Catalyst broadcasts it in a later join only when it is under
    ``spark.sql.autoBroadcastJoinThreshold`` and otherwise plans a sort-merge join.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def deal(df: DataFrame, tasks: int) -> DataFrame:
    """The rows of ``df`` over ``tasks`` tasks, each dealt by its number, so equal rows part as well.

    ``repartition(tasks)`` would sort all rows of a task first, in memory that grows with what one task reads. So would
    Spark's shuffle writer hold them for more tasks than ``spark.shuffle.sort.bypassMergeThreshold``; no more are dealt to.
    """
    tasks = min(tasks, int(df.sparkSession.conf.get("spark.shuffle.sort.bypassMergeThreshold", "200")))
    return df.withColumn("_row", F.monotonically_increasing_id()).repartition(tasks, "_row").drop("_row")
