"""Progress of streaming queries as a table that outlives queries, sessions and restarts."""

from __future__ import annotations

import threading
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery

SCHEMA = """query_id string, run_id string, query string, batch_id long, at timestamp, input_rows long, input_rate double,
    processing_rate double, batch_duration_ms long, late_rows long"""

#: rows that wait in the driver before they are written
BUFFER = 200


class ProgressTable(StreamingQueryListener):
    """Writes one row per micro-batch of all queries of a session to a Parquet table.

    The driver holds at most ``buffer`` rows and one set of totals per query. Totals belong to the query, that is
    to its checkpoint, and go on where the table ends after a restart. Rows are written when the
    buffer is full and when a query ends. Attach with ``spark.streams.addListener`` before the query starts.
    """

    def __init__(self, spark: SparkSession, path: str, buffer: int = BUFFER):
        self.spark, self.path, self.buffer = spark, path, buffer
        self.rows: list[tuple] = []
        self.totals: dict[str, dict[str, int]] = {}
        self.lock, self.ended = threading.RLock(), {}
        if _exists(spark, path):
            # a row per query
            for r in read_progress(spark, path).groupBy("query_id").agg(
                    F.max("batch_id").alias("last"), F.sum("input_rows").alias("rows"), F.sum("late_rows").alias("late"),
                    F.count(F.lit(1)).alias("batches")).collect():
                self.totals[r["query_id"]] = {k: r[k] for k in ("last", "rows", "late", "batches")}

    def onQueryStarted(self, event):
        with self.lock:
            self.ended.setdefault(str(event.runId), threading.Event())

    def onQueryProgress(self, event):
        p = event.progress
        late = sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
        at = datetime.fromisoformat(p.timestamp.replace("Z", "+00:00")).astimezone(timezone.utc)
        rates = [sum(getattr(s, name) or 0.0 for s in p.sources) for name in ("inputRowsPerSecond", "processedRowsPerSecond")]
        with self.lock:
            self.rows.append((str(p.id), str(p.runId), p.name, p.batchId, at, p.numInputRows, *rates, p.batchDuration, late))
            total = self.totals.setdefault(str(p.id), {"last": -1, "rows": 0, "late": 0, "batches": 0})
            if p.batchId > total["last"]:  # a batch done again after a restart counts once
                total.update(last=p.batchId, rows=total["rows"] + p.numInputRows, late=total["late"] + late,
                             batches=total["batches"] + 1)
            if len(self.rows) >= self.buffer:
                self.flush()

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self.flush()
        with self.lock:
            self.ended.setdefault(str(event.runId), threading.Event()).set()

    def flush(self) -> None:
        """Write what waits; if that fails, it goes on waiting."""
        with self.lock:
            if self.rows:
                (self.spark.createDataFrame(self.rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.path))
                self.rows = []

    def wait(self, query: StreamingQuery, seconds: float = 60) -> bool:
        """Until the end of a query has arrived here and its rows are written; events come a moment late."""
        with self.lock:
            ended = self.ended.setdefault(str(query.runId), threading.Event())
        return ended.wait(seconds)

    def late_rows(self, query: StreamingQuery) -> int:
        """Rows dropped behind the watermark in all runs of the query."""
        return self.totals.get(str(query.id), {}).get("late", 0)

    def input_rows(self, query: StreamingQuery) -> int:
        return self.totals.get(str(query.id), {}).get("rows", 0)


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """One row per query and micro-batch; of a batch done again the last one."""
    again = Window.partitionBy("query_id", "batch_id").orderBy(F.desc("at"), F.desc("run_id"))
    return (spark.read.schema(SCHEMA).parquet(path).withColumn("_again", F.row_number().over(again))
            .filter("_again = 1").drop("_again"))
