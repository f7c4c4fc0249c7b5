"""Live views: trades beside the predictions of their windows, and the newest trades of each symbol."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import Row

from tapewatch.operators.ordering import ArrivalOrder, last_n
from tapewatch.operators.windows import micros
from tapewatch.schema import KEPT_TRADES_PER_SYMBOL, WATERMARK_DELAY, WINDOW_SIZE, WINDOW_SLIDE
from tapewatch.streaming.run import use_large_state

# ---- trades beside predictions ----------------------------------------------------------------


def stream_trades_in_windows(trades: DataFrame, predictions: DataFrame, size: str = WINDOW_SIZE, slide: str = WINDOW_SLIDE,
                             delay: str = WATERMARK_DELAY, prediction_delay: str | None = None) -> DataFrame:
    """``trades_in_windows`` of two live tables: a row when a trade and the prediction of a window that covers it are both there.

    Both sides wait in the state. The watermark is that of the slower side: a trade goes when it lies before all
    windows that can still be predicted, a prediction when its window lies before all trades that can still come.
    Predictions come in the order of their windows, at most ``prediction_delay`` (one window unless given) behind the
    newest; later ones, and trades later than ``delay``, are dropped. Unknown symbols match nothing.
    """
    span, step = micros(size), micros(slide)
    at = F.unix_micros("event_time")
    newest = at - F.pmod(at, F.lit(step))
    starts = F.filter(F.transform(F.sequence(F.lit(0), F.lit(-(-span // step) - 1)), lambda i: newest - i * F.lit(step)),
                      lambda s: s > at - F.lit(span))
    placed = (trades.withWatermark("event_time", delay).withColumn("_start", F.explode(starts))
              .withColumn("_start", F.timestamp_micros("_start")).alias("t"))
    flags = (predictions.select("symbol", "window_start", "prediction", "probability")
             .withWatermark("window_start", prediction_delay or size).alias("p"))
    length = F.expr(f"INTERVAL '{span // 1_000_000}.{span % 1_000_000:06d}' SECOND")
    covered = ((F.col("t.symbol") == F.col("p.symbol")) & (F.col("t._start") == F.col("p.window_start"))
               & (F.col("t.event_time") >= F.col("p.window_start")) & (F.col("t.event_time") < F.col("p.window_start") + length))
    columns = [F.col(f"t.{c}") for c in trades.columns]
    return placed.join(flags, covered).select(
        *columns, F.col("p.window_start").alias("window_start"), (F.col("p.window_start") + length).alias("window_end"),
        "prediction", "probability")


def state_rows(query: StreamingQuery) -> int:
    """Rows that the state of a query holds, as of its last batch."""
    return sum(op["numRowsTotal"] for op in query.lastProgress["stateOperators"]) if query.lastProgress else 0


# ---- newest trades ----------------------------------------------------------------------------

def _newest_first(columns: list[str]):
    """Sort key: later first, null last of all."""
    return lambda row: tuple((row[c] is not None, row[c] if row[c] is not None else 0) for c in columns)


class KeepNewest(StatefulProcessor):
    """Keeps at least the newest ``n`` rows of a key and at most twice as many.

    New rows are added as they come; only when 2 n are reached the older half goes, so a batch does not rewrite what
    is there. With ``idle_ms`` a timer forgets a key whose newest row is that much older than the watermark.
    """

    def __init__(self, schema: T.StructType, order: list[str], n: int, idle_ms: int | None):
        self.schema, self.order, self.n, self.idle_ms = schema, order, n, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("newest", self.schema)
        self.count = handle.getValueState("count", "held int, newest long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        names, rank = self.schema.names, _newest_first(self.order)
        arrived = sorted(rows, key=rank, reverse=True)[:self.n]
        held, newest = self.count.get() if self.count.exists() else (0, 0)
        fresh = [tuple(r[c] for c in names) for r in arrived]
        if held + len(fresh) > 2 * self.n:
            every = [Row(**dict(zip(names, r))) for r in (*self.rows.get(), *fresh)]
            fresh = [tuple(r) for r in sorted(every, key=rank, reverse=True)[:self.n]]
            self.rows.put(fresh)
            held = len(fresh)
        else:
            self.rows.appendList(fresh)
            held += len(fresh)
        newest = max([newest, *[r["_at"] for r in arrived if r["_at"] is not None]])
        self.count.update((held, newest))
        if self.idle_ms is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(newest // 1_000 + self.idle_ms)
        yield Row(symbol=key[0], salt=key[1], held=held)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.rows.clear()
        self.count.clear()
        return iter([])

    def close(self) -> None:
        pass


def keep_newest(trades: DataFrame, n: int = KEPT_TRADES_PER_SYMBOL, order: ArrivalOrder = ArrivalOrder(), salts: int = 16,
                idle: str | None = None, delay: str = WATERMARK_DELAY) -> DataFrame:
    """State with the newest ``n`` trades of each symbol; returns the number of rows that each touched state holds.

    A symbol is ``salts`` states, told by a hash of the order, so a busy symbol is the work of several tasks; each holds
    at most 2 n rows. ``newest_trades`` reads the view. ``idle`` forgets symbols without trades for so long.
    """
    use_large_state(trades.sparkSession)
    ordered = ["_at", *order.tiebreak]
    source = trades.withWatermark("event_time", delay) if idle else trades
    rows = (source.withColumn("_at", F.unix_micros(order.time))
            .withColumn("_salt", F.pmod(F.xxhash64(order.time, *order.tiebreak), F.lit(salts)).cast("int")))
    kept = T.StructType([f for f in rows.schema.fields if f.name not in ("symbol", "_salt", order.time)])
    processor = KeepNewest(kept, ordered, n, micros(idle) // 1_000 if idle else None)
    return rows.groupBy("symbol", "_salt").transformWithState(
        statefulProcessor=processor, outputStructType="symbol string, salt int, held int", outputMode="Update",
        timeMode="EventTime" if idle else "None")


def newest_trades(spark: SparkSession, checkpoint: str, n: int = KEPT_TRADES_PER_SYMBOL,
                  order: ArrivalOrder = ArrivalOrder()) -> DataFrame:
    """The newest ``n`` trades of each symbol as of the last finished batch of a query over ``keep_newest``."""
    state = (spark.read.format("statestore").option("stateVarName", "newest").load(checkpoint)
             .select("key.symbol", "list_element.*").withColumn(order.time, F.timestamp_micros("_at")).drop("_at"))
    return last_n(state, ["symbol"], order, n)
