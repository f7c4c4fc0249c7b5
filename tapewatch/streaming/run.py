"""Start, bound and observe streaming queries."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery

from tapewatch.schema import TRIGGER_INTERVAL

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_large_state(spark: SparkSession) -> None:
    """Keep window state in RocksDB, off the heap, with changelog checkpoints."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def _started(writer, checkpoint: str, interval: str | None, name: str | None) -> StreamingQuery:
    """``interval=None`` works off what is there and stops; otherwise one batch per interval."""
    writer = writer.option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def run_to_parquet(df: DataFrame, path: str, checkpoint: str, interval: str | None = TRIGGER_INTERVAL,
                   name: str | None = None, partition_by: str | None = None) -> StreamingQuery:
    """Append finished rows to Parquet files; the sink's log makes each batch count once."""
    use_large_state(df.sparkSession)
    writer = df.writeStream.outputMode("append").format("parquet").option("path", path)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    return _started(writer, checkpoint, interval, name)


def run_foreach_batch(df: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str,
                      interval: str | None = TRIGGER_INTERVAL, name: str | None = None) -> StreamingQuery:
    return _started(df.writeStream.foreachBatch(fn), checkpoint, interval, name)


def run_for(query: StreamingQuery, seconds: float) -> bool:
    """Let the query run for at most ``seconds``, then stop it; True if it ended by itself."""
    ended = bool(query.awaitTermination(seconds))
    if not ended:
        query.stop()
    return ended


#: batches of a run that a ProgressLog can name the rates of; a ProgressTable keeps all
REMEMBERED = 1_000


class ProgressLog(StreamingQueryListener):
    """Late rows of all batches of a session's queries, and the rates of their last batches, also of those a query
    itself has forgotten. For long runs use a ``ProgressTable``.

    Attach with ``spark.streams.addListener(log)`` before the query starts; events arrive a moment late.
    """

    def __init__(self):
        self.late: dict[str, int] = {}
        self.rates: dict[str, deque[tuple[int, int, float, float]]] = {}

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p, run_id = event.progress, str(event.progress.runId)
        self.late[run_id] = self.late.get(run_id, 0) + sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
        self.rates.setdefault(run_id, deque(maxlen=REMEMBERED)).append(
            (p.batchId, p.numInputRows, p.inputRowsPerSecond or 0.0, p.processedRowsPerSecond or 0.0))

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


def late_rows(query: StreamingQuery, log: ProgressLog | None = None) -> int:
    """Rows dropped behind the watermark: in all batches that ``log`` saw, else in those the query still remembers."""
    if log is not None:
        return log.late.get(str(query.runId), 0)
    return sum(op["numRowsDroppedByWatermark"]
               for progress in query.recentProgress for op in progress["stateOperators"])


def progress_rates(query: StreamingQuery, log: ProgressLog | None = None) -> list[tuple[int, int, float, float]]:
    """(batch, rows, input rate, processing rate) of all batches that ``log`` saw, else of those the query remembers."""
    if log is not None:
        return list(log.rates.get(str(query.runId), []))
    return [(p["batchId"], p["numInputRows"], p["inputRowsPerSecond"] or 0.0,
             p["processedRowsPerSecond"] or 0.0) for p in query.recentProgress]
