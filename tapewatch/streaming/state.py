"""Windows that are still open, read from the state of a stopped stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapewatch.schema import STATISTICS

# What Spark keeps for the aggregates of ``window_stats``, in their order: one field or more for each.
_BUFFERS = ["min", "max", "sum", "count", "n", "avg", "m2", "count", "sum", "valueWithExtremumOrdering", "extremumOrdering",
            "valueWithExtremumOrdering", "extremumOrdering", "n", "avg", "m2"]
_NAMES = ["price_min", "price_max", "_sum", "_known", "_n", "_mean", "_m2", "trade_count", "total_volume", "price_first", "_first",
          "price_last", "_last", "_n2", "_mean2", "_m22"]


def open_windows(spark: SparkSession, checkpoint: str, ddof: int = 1) -> DataFrame:
    """``window_stats`` so far of the windows that a stream over ``checkpoint`` has not closed.

    Reads the state as of the last finished batch; the stream must not run meanwhile. ``ddof`` is the one the stream
    was made with. A restarted stream goes on from the same state and returns these windows when they close.
    """
    state = spark.read.format("statestore").load(checkpoint)
    held = state.schema["value"].dataType
    if held.names != _BUFFERS:
        raise ValueError(f"not the state of window statistics: {held.names}")
    # a cast goes by place, as the fields' own names repeat
    named = T.StructType([T.StructField(name, f.dataType) for name, f in zip(_NAMES, held.fields)])
    flat = state.select("key.symbol", "key.window", F.col("value").cast(named).alias("value")).select("symbol", "window", "value.*")
    spread = F.col("_n") - ddof
    variance = F.when(spread > 0, F.col("_m2") / spread) if ddof else F.when(F.col("_n") > 0, F.col("_m2") / F.col("_n"))
    return flat.withColumns({
        "window_start": F.col("window.start"), "window_end": F.col("window.end"),
        "price_avg": F.when(F.col("_known") > 0, F.col("_sum") / F.col("_known")),
        "price_variance": variance, "price_stddev": F.sqrt(variance)}).select(*STATISTICS)
