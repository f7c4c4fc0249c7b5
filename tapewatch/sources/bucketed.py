"""Tables that are stored in buckets of their join keys, so that joins between them move nothing.

A join of two such tables with the same keys and number of buckets reads bucket beside bucket: no shuffle, and no sort
where a bucket is one file. The layout is kept in a small file beside the data, so another session can use it.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tapewatch.sources.published import _Store

WINDOW_KEYS = ("symbol", "window_start")
LAYOUT = "_layout/buckets.json"


def _table_name(path: str) -> str:
    return f"bucketed_{hashlib.md5(path.encode()).hexdigest()}"


def _quoted(names: Sequence[str]) -> str:
    return ", ".join(f"`{n}`" for n in names)


def write_bucketed(df: DataFrame, path: str, buckets: int, by: Sequence[str] = WINDOW_KEYS) -> DataFrame:
    """Replace the table at ``path`` by ``df`` in ``buckets`` buckets of ``by``, each one sorted file; returns the table.

    Tables that are to be joined need the same number: choose it for buckets of some hundred megabytes.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    spark.sql(f"DROP TABLE IF EXISTS {_table_name(path)}")
    (df.repartition(buckets, *by).write.mode("overwrite").bucketBy(buckets, *by).sortBy(*by)
     .option("path", path).format("parquet").saveAsTable(_table_name(path)))
    store, layout = _Store(spark, path), f"{path}/{LAYOUT}"
    store.delete(layout)
    store.create(layout, json.dumps({"schema": df.schema.jsonValue(), "buckets": buckets, "by": list(by)}))
    return spark.table(_table_name(path))


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """The table at ``path`` with its buckets, whichever session has written it."""
    path, name = path.rstrip("/"), _table_name(path.rstrip("/"))
    if not spark.catalog.tableExists(name):
        layout = json.loads(spark.read.text(f"{path}/{LAYOUT}", wholetext=True).first()["value"])
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in T.StructType.fromJson(layout["schema"]).fields)
        keys = _quoted(layout["by"])
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
                  f"INTO {layout['buckets']} BUCKETS LOCATION '{path}'")
    return spark.table(name)
