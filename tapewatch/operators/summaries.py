"""Counts, shares, histograms and reports; each is one pass unless its docstring says otherwise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapewatch.functions.scalars import finite
from tapewatch.operators.ordering import global_index, running_total
from tapewatch.schema import ANOMALOUS, FEATURES, SHOWN_PREDICTIONS
from tapewatch.session import settle


def group_count(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def count_where(df: DataFrame, **conditions: Column) -> DataFrame:
    """One row with the number of rows meeting each named condition."""
    return df.agg(*[F.count_if(c).alias(name) for name, c in conditions.items()])


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"), (F.count(F.lit(1)) == 0).alias("is_empty"))


def group_mean_sum(df: DataFrame, key: str, value: str) -> DataFrame:
    return df.groupBy(key).agg(F.avg(value).alias(f"avg_{value}"), F.sum(value).alias(f"sum_{value}"))


def confusion(df: DataFrame, label: str = "label_binary", prediction: str = "prediction") -> DataFrame:
    return group_count(df, label, prediction).orderBy(label, prediction)


def windows_per_symbol(stats: DataFrame) -> DataFrame:
    return (stats.groupBy("symbol").agg(F.count(F.lit(1)).alias("windows"))
            .orderBy(F.desc("windows"), "symbol"))


def mean_trades_per_window(stats: DataFrame) -> DataFrame:
    return (stats.groupBy("symbol").agg(F.avg("trade_count").alias("mean_trades"))
            .orderBy(F.desc("mean_trades"), "symbol"))


def _is_anomaly(label: str) -> Column:
    return F.col(label) == ANOMALOUS


def anomaly_share(df: DataFrame, label: str = "label") -> DataFrame:
    hits, rows = F.count_if(_is_anomaly(label)), F.count(F.lit(1))
    share = F.coalesce(F.try_divide(hits * F.lit(100.0), rows), F.lit(0.0))
    return df.agg(hits.alias("anomalies"), rows.alias("windows"), share.alias("anomaly_pct"))


def anomaly_rate_by_symbol(df: DataFrame, label: str = "label") -> DataFrame:
    return (df.groupBy("symbol")
            .agg((F.count_if(_is_anomaly(label)) * F.lit(100.0) / F.count(F.lit(1))).alias("anomaly_pct"))
            .orderBy(F.desc("anomaly_pct"), "symbol"))


def cluster_by_symbol(df: DataFrame, clusters: Sequence[int], cluster: str = "prediction") -> DataFrame:
    """Windows per symbol and cluster, one column per cluster, 0 where there are none."""
    return df.groupBy("symbol").agg(
        *[F.count_if(F.col(cluster) == c).alias(f"cluster_{c}") for c in clusters])


def empirical_threshold(df: DataFrame, distance: str = "distance_to_centroid",
                        label: str = "label") -> DataFrame:
    """Smallest distance that was labelled anomalous."""
    return df.filter(_is_anomaly(label)).agg(F.min(distance).alias("threshold"))


def session_totals(trades: DataFrame, predictions: DataFrame, label: str = "label") -> DataFrame:
    """Trades, windows and anomalies as one row: two aggregates of one row each, stacked and summed."""
    zero = F.lit(0).cast("long")
    sides = (
        trades.agg(F.count(F.lit(1)).alias("total_trades"))
        .select("total_trades", zero.alias("total_windows"), zero.alias("total_anomalies"))
        .unionByName(predictions.agg(F.count(F.lit(1)).alias("total_windows"),
                                     F.count_if(_is_anomaly(label)).alias("total_anomalies"))
                     .withColumn("total_trades", zero)))
    names = ("total_trades", "total_windows", "total_anomalies")
    return sides.agg(*[F.sum(c).alias(c) for c in names])


def _bin(value: Column, lo: float, hi: float, bins: int) -> Column:
    """0-based equal-width bin; the last bin includes ``hi``, values outside give null."""
    place = F.floor((value - F.lit(lo)) * F.lit(float(bins)) / F.lit(hi - lo))
    return F.when((value >= lo) & (value <= hi), F.least(place, F.lit(bins - 1))).cast("int")


def _widened(lo: float | None, hi: float | None) -> tuple[float, float]:
    lo, hi = (0.0, 1.0) if lo is None or hi is None else (float(lo), float(hi))
    return (lo - 0.5, hi + 0.5) if lo == hi else (lo, hi)


def histogram(df: DataFrame, column: str, bins: int, lo: float | None = None, hi: float | None = None,
              density: bool = False) -> DataFrame:
    """Equal-width histogram with all bins, empty ones too.

    Without bounds one extra pass finds the minimum and maximum. NaN and infinite values are in no bin.
    """
    if lo is None or hi is None:
        found = df.agg(F.min(finite(column)).alias("lo"), F.max(finite(column)).alias("hi")).first()
        lo, hi = (found["lo"] if lo is None else lo), (found["hi"] if hi is None else hi)
    lo, hi = _widened(lo, hi)
    width = (hi - lo) / bins
    counted = (df.select(_bin(F.col(column), lo, hi, bins).alias("bin")).filter("bin is not null")
               .groupBy("bin").agg(F.count(F.lit(1)).alias("n")))
    # one row per bin on both sides
    all_bins = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    full = (all_bins.join(F.broadcast(counted), "bin", "left")
            .select("bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_lo"),
                    (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("bin_hi"),
                    F.coalesce("n", F.lit(0)).alias("n")))
    if not density:
        return full
    total = full.agg(F.sum("n").alias("n")).first()["n"] or 0
    share = F.col("n") / F.lit(total * width) if total else F.lit(0.0)
    return full.withColumn("density", share).drop("n")


def feature_drift(first: DataFrame, second: DataFrame, bins: int = 30,
                  features: Sequence[str] = tuple(FEATURES)) -> DataFrame:
    """Density of every feature in two data sets, on shared bins, empty ones too: feature, side, bin, n, density.

    Two passes: bounds of all features, then all bins of all features. Only finite values count.
    """
    both = (first.select(*features, F.lit("first").alias("side"))
            .unionByName(second.select(*features, F.lit("second").alias("side"))))
    aggs = [agg for f in features for agg in (F.min(finite(f)).alias(f"lo_{f}"), F.max(finite(f)).alias(f"hi_{f}"))]
    bounds = both.agg(*aggs).first()
    spread = {f: _widened(bounds[f"lo_{f}"], bounds[f"hi_{f}"]) for f in features}
    binned = both.select("side", *[_bin(F.col(f), *spread[f], bins).alias(f) for f in features])
    counts = (binned.unpivot(["side"], list(features), "feature", "bin").filter("bin is not null")
              .groupBy("feature", "side", "bin").agg(F.count(F.lit(1)).alias("n")))
    totals = counts.groupBy("feature", "side").agg(F.sum("n").alias("total"))
    width = F.create_map(*[x for f in features
                           for x in (F.lit(f), F.lit((spread[f][1] - spread[f][0]) / bins))])
    # two rows per feature, and as many per bin
    grid = (totals.select("feature", "side", "total", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")))
    n = F.coalesce("n", F.lit(0))
    return (grid.join(F.broadcast(counts), ["feature", "side", "bin"], "left")
            .select("feature", "side", "bin", n.alias("n"),
                    (n / (F.col("total") * F.element_at(width, F.col("feature")))).alias("density")))


def stats_by_price_range(trades: DataFrame, edges: Sequence[float]) -> DataFrame:
    """Price and volume statistics per symbol and price range.

    Range i is [edges[i-1], edges[i]); range 0 lies below the first edge, the last above the last.
    """
    price_range = F.when(F.col("price") < float(edges[0]), 0)
    for i, edge in enumerate(edges[1:], start=1):
        price_range = price_range.when(F.col("price") < float(edge), i)
    price_range = price_range.when(F.col("price").isNotNull(), len(edges))
    return trades.groupBy("symbol", price_range.alias("price_range")).agg(
        F.min("price").alias("price_min"), F.max("price").alias("price_max"),
        F.avg("price").alias("price_avg"), F.var_samp("price").alias("price_variance"),
        F.count(F.lit(1)).alias("trade_count"), F.sum("quantity").alias("total_volume"))


def throughput(trades: DataFrame, every: str = "1 second") -> DataFrame:
    """Messages per second in each interval that has any, and on average up to its end."""
    counted = (trades.groupBy(F.window("event_time", every).alias("w"))
               .agg(F.count(F.lit(1)).alias("messages"))
               .select(F.col("w.start").alias("interval_start"), F.col("w.end").alias("interval_end"),
                       "messages"))
    summed = running_total(counted, ["interval_start"], ["messages"])
    start = summed.select(F.min(F.unix_micros("interval_start"))).scalar()
    end = F.unix_micros("interval_end")
    so_far = F.col("messages_before") + F.col("messages")
    return summed.select(
        "interval_start", "messages",
        (F.col("messages") * F.lit(1e6) / (end - F.unix_micros("interval_start"))).alias("current_rate"),
        (so_far * F.lit(1e6) / (end - start)).alias("average_rate"))


def throughput_reports(trades: DataFrame, order: Sequence[str], every_n: int = 500) -> DataFrame:
    """A report after every ``every_n`` messages: rate since the report before, and since the start.

    The clock starts with the first message. Zero elapsed time gives rate 0.
    """
    indexed = global_index(trades.select(*order), order, "_i")
    number = F.col("_i") + 1
    due = indexed.filter((number % every_n == 0) | (F.col("_i") == 0))
    at = F.unix_micros(F.col(order[0]))
    marks = settle(due.select(F.floor(number / every_n).cast("long").alias("report"), number.alias("messages"),
                              at.alias("at")), "marks")
    start = marks.filter("messages = 1").select("at").scalar()
    reports = marks.filter(F.col("messages") % every_n == 0)
    previous = reports.select((F.col("report") + 1).alias("report"), F.col("at").alias("before"))
    both = reports.join(previous, "report", "left")
    since_last = (F.col("at") - F.coalesce("before", start)) / F.lit(1e6)
    since_start = (F.col("at") - start) / F.lit(1e6)
    return both.select(
        "report", "messages",
        F.when(since_last > 0, F.lit(float(every_n)) / since_last).otherwise(0.0).alias("current_rate"),
        F.when(since_start > 0, F.col("messages") / since_start).otherwise(0.0).alias("average_rate"))


def recent_predictions(predictions: DataFrame, n: int = SHOWN_PREDICTIONS,
                       ts: str = "window_start") -> DataFrame:
    return predictions.orderBy(F.col(ts).desc(), "symbol").limit(n)


def latest_prediction(predictions: DataFrame, ts: str = "window_start") -> DataFrame:
    return recent_predictions(predictions, 1, ts)
