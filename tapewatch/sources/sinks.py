"""Parquet and CSV sinks that can be repeated without duplicating rows."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapewatch.functions.scalars import fmt_ts


def overwrite_parquet(df: DataFrame, path: str, partition_by: str | None = None,
                      **counts: Column) -> dict[str, int]:
    """Replace a table; returns its row count and the named counts.

    The counts come from what was written (file footers and the columns they name), not from
    running ``df`` again. An observation would save that read, but a session that has used one can
    no longer ship freshly fitted models to its tasks.
    """
    writer = df.write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    return written.agg(F.count(F.lit(1)).alias("rows"),
                       *[F.count_if(c).alias(name) for name, c in counts.items()]).first().asDict()


def append_parquet(df: DataFrame, path: str, batch_id: int, **counts: Column) -> dict[str, int]:
    """Add one micro-batch under ``batch_id=<n>``; a retried batch replaces itself."""
    return overwrite_parquet(df, f"{path}/batch_id={batch_id}", **counts)


def compact(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Rewrite many small files as few of the advisory size (adaptive rebalance)."""
    spark.read.parquet(source).hint("rebalance").write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


def export_view(df: DataFrame) -> DataFrame:
    """Text-friendly columns: ``<ts>_str`` beside each timestamp, vectors as JSON arrays."""
    columns = []
    for field in df.schema.fields:
        c = F.col(field.name)
        if isinstance(field.dataType, VectorUDT):
            columns.append(F.to_json(vector_to_array(c)).alias(field.name))
        elif isinstance(field.dataType, T.TimestampType):
            columns += [c, fmt_ts(c).alias(f"{field.name}_str")]
        else:
            columns.append(c)
    return df.select(*columns)


def export_csv(df: DataFrame, path: str, order_by: str | None = None, single_file: bool = False) -> None:
    """CSV with header. Sorting is a range-partitioned global sort, so the files are in order.

    ``single_file`` is for summaries known to be small; it puts all rows through one task.
    """
    out = export_view(df)
    if order_by and order_by in out.columns:
        out = out.orderBy(order_by)
    if single_file:
        out = out.coalesce(1)
    out.write.mode("overwrite").option("header", True).csv(path)
