"""Look-ups and overlays between trades, windows, predictions and centroids."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapewatch.functions.frames import recent
from tapewatch.functions.scalars import squared_distance_to
from tapewatch.operators.lookup import lookup


def _literal(points: Sequence[Sequence[float]]) -> Column:
    return F.array(*[F.array(*[F.lit(float(v)) for v in p]) for p in points])


def with_own_centroid(df: DataFrame, centroids: Sequence[Sequence[float]],
                      cluster: str = "prediction") -> DataFrame:
    """Adds ``centroid``: the array of the row's own cluster. The k centroids are plan literals."""
    return df.withColumn("centroid", F.get(_literal(centroids), F.col(cluster)))


def assign_nearest(df: DataFrame, columns: Sequence[str], centroids: Sequence[Sequence[float]],
                   cluster: str = "prediction", distance: str = "distance_to_centroid") -> DataFrame:
    """Nearest of k centroids and the Euclidean distance to it; ties go to the smaller number."""
    squares = F.array(*[squared_distance_to(columns, c) for c in centroids])
    return (df.withColumn("_d2", squares)
            .withColumn(cluster, (F.array_position("_d2", F.array_min("_d2")) - 1).cast("int"))
            .withColumn(distance, F.sqrt(F.array_min("_d2")))
            .drop("_d2"))


def overlay_anomalies(prices: DataFrame, predictions: DataFrame) -> DataFrame:
    """Price windows with ``is_anomaly`` and the probability, where there is a prediction."""
    flags = predictions.select("symbol", "window_start",
                               (F.col("prediction") == 1).alias("is_anomaly"), "probability")
    joined = prices.join(flags, ["symbol", "window_start"], "left")
    return joined.withColumn("is_anomaly", F.coalesce("is_anomaly", F.lit(False)))


def recently_anomalous(predictions: DataFrame, asof: datetime | Column, seconds: int,
                       ts: str = "window_start") -> DataFrame:
    return (recent(predictions, asof, seconds, ts)
            .filter(F.col("prediction") == 1).select("symbol").distinct())


def trades_of_anomalous(trades: DataFrame, predictions: DataFrame, asof: datetime | Column,
                        seconds: int = 300, ts: str = "window_start") -> DataFrame:
    """Trades of symbols that had an anomalous window in the last ``seconds`` before ``asof``."""
    named = recently_anomalous(predictions, asof, seconds, ts).filter(F.col("symbol").isNotNull())
    return lookup(trades, named, ["symbol"], "left_semi")


def trades_in_windows(trades: DataFrame, predictions: DataFrame, size: str, slide: str) -> DataFrame:
    """Each trade beside the prediction of every window that covers it.

    The range condition becomes equality: a trade is expanded to the starts of its windows. A
    window holding very many trades is one row on the other side.
    """
    flags = predictions.select("symbol", "window_start", "prediction", "probability")
    placed = (trades.withColumn("window", F.window("event_time", size, slide))
              .withColumns({"window_start": F.col("window.start"), "window_end": F.col("window.end")})
              .drop("window"))
    return placed.join(flags, ["symbol", "window_start"])
