"""Time-series views: latest price, trailing change, recent rows, moving averages."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapewatch.functions.frames import recent, seconds_before
from tapewatch.operators.lookup import lookup
from tapewatch.operators.ordering import ArrivalOrder, extreme_by, last_n, trailing_rows
from tapewatch.schema import KEPT_TRADES_PER_SYMBOL


def latest_price(trades: DataFrame, order: ArrivalOrder = ArrivalOrder()) -> DataFrame:
    return extreme_by(trades, ["symbol"], "price", order)


def trailing_change(trades: DataFrame, asof: datetime | Column | None = None, seconds: int = 60,
                    order: ArrivalOrder = ArrivalOrder()) -> DataFrame:
    """First and last price of each symbol in the trailing range, and the change in percent.

    Without ``asof`` each symbol looks back from its own newest trade. With fewer than two trades,
    or a first price of zero, the change is null.
    """
    if asof is None:
        newest = trades.groupBy("symbol").agg(F.max("event_time").alias("_asof"))
        inside, until = recent(lookup(trades, newest, ["symbol"]), F.col("_asof"), seconds), F.col("_asof")
    else:
        inside, until = recent(trades, asof, seconds), asof
    inside = inside.withColumn("_arrival", order.key(inside, seconds_before(until, seconds), seconds * 1_000_000))
    first, last = F.col("first_price"), F.col("last_price")
    change = F.when((F.col("trades") >= 2) & (first != 0), (last - first) / first * 100)
    return (inside.groupBy("symbol")
            .agg(F.min_by("price", "_arrival").alias("first_price"), F.max_by("price", "_arrival").alias("last_price"),
                 F.count(F.lit(1)).alias("trades"))
            .withColumn("change_pct", change))


def pct_change_from_start(trades: DataFrame, order: ArrivalOrder = ArrivalOrder()) -> DataFrame:
    """Change in percent of every trade against the first price of its symbol in ``trades``."""
    base = (extreme_by(trades, ["symbol"], "price", order, last=False)
            .select("symbol", F.col("price").alias("base_price")))
    change = F.when(F.col("base_price") != 0,
                    (F.col("price") - F.col("base_price")) / F.col("base_price") * 100)
    return lookup(trades, base, ["symbol"]).withColumn("pct_change", change)


def last_n_per_symbol(trades: DataFrame, n: int = KEPT_TRADES_PER_SYMBOL,
                      order: ArrivalOrder = ArrivalOrder()) -> DataFrame:
    return last_n(trades, ["symbol"], order, n)


def volume_ratio(stats: DataFrame, n: int) -> DataFrame:
    """Volume of a window against the mean of the n windows before it of the same symbol."""
    averaged = trailing_rows(stats, ["symbol"], ["window_start"], n,
                             {"volume_moving_avg": F.avg("total_volume")})
    return averaged.withColumn("volume_ratio",
                               F.try_divide(F.col("total_volume"), F.col("volume_moving_avg")))


def price_band(stats: DataFrame, symbols: Sequence[str]) -> DataFrame:
    return (stats.filter(F.col("symbol").isin(list(symbols)))
            .select("symbol", "window_start", "price_avg", "price_min", "price_max")
            .orderBy("symbol", "window_start"))
