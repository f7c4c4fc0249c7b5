"""The three stages end to end: accumulate and label, train, score; files in between."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewatch.functions.frames import rename
from tapewatch.functions.scalars import epoch_seconds
from tapewatch.operators.classify import evaluator_metrics, lr_fit, save_model, split
from tapewatch.operators.cluster import Choice, check_trainable, cluster_and_label
from tapewatch.operators.ordering import ArrivalOrder
from tapewatch.operators.windows import window_features, window_stats
from tapewatch.schema import FEATURES, TRIGGER_INTERVAL, WATERMARK_DELAY, WINDOW_SIZE, WINDOW_SLIDE
from tapewatch.sources.sinks import overwrite_parquet
from tapewatch.sources.trades import trade_stream
from tapewatch.streaming.run import run_for, run_to_parquet
from tapewatch.streaming.state import open_windows
from tapewatch.streaming.windows import stream_score, stream_window_stats

log = logging.getLogger(__name__)

@dataclass(frozen=True)
class Windowing:
    size: str = WINDOW_SIZE
    slide: str = WINDOW_SLIDE
    delay: str = WATERMARK_DELAY
    order: ArrivalOrder = ArrivalOrder()


def features_of(trades: DataFrame, windowing: Windowing = Windowing()) -> DataFrame:
    return window_features(window_stats(trades, windowing.size, windowing.slide, order=windowing.order))


def accumulate(spark: SparkSession, source, path: str, checkpoint: str, seconds: float,
               windowing: Windowing = Windowing(), keep: Sequence[str] = (),
               interval: str | None = TRIGGER_INTERVAL, still_open: bool = False) -> DataFrame:
    """Collect features of closed windows from a live source for a while; returns what is there.

    ``still_open`` adds the windows that the watermark has not passed yet, as they are in the state; they are not
    written, as the next run writes them when they close.
    """
    trades = trade_stream(spark, source, keep)
    stats = stream_window_stats(trades, windowing.size, windowing.slide, windowing.delay, windowing.order)
    features = window_features(stats)
    run_for(run_to_parquet(features, path, checkpoint, interval), seconds)
    closed = spark.read.schema(features.schema).parquet(path)
    return closed.unionByName(window_features(open_windows(spark, checkpoint))) if still_open else closed


def label_windows(features: DataFrame, labeled_path: str, model_path: str | None = None,
                  **options) -> Choice | None:
    """Cluster, label and save the windows; None when there are too few."""
    found = cluster_and_label(features, **options)
    if found is None:
        log.warning("too few complete windows to cluster")
        return None
    labeled, choice = found
    counts = overwrite_parquet(labeled, labeled_path, anomalous=F.col("label_binary") == 1)
    log.info("k=%d, silhouette %.4f, %d of %d windows anomalous", choice.k, choice.score,
             counts["anomalous"], counts["rows"])
    if model_path:
        save_model(choice.model, model_path)
    return choice


def window_keys() -> list:
    return ["symbol", epoch_seconds("window_start")]


def train_classifier(labeled: DataFrame, model_path: str | None = None,
                     ratio: float = 0.8) -> tuple[PipelineModel, dict[str, float], DataFrame]:
    """Fit on the hash-split training rows; returns model, test metrics and scored test rows."""
    if "prediction" in labeled.columns:
        labeled = rename(labeled, "prediction", "kmeans_cluster")
    clean = labeled.dropna(subset=[*FEATURES, "label_binary"])
    train, test = split(clean, window_keys(), ratio)
    ready = check_trainable(train, "label_binary")
    if not ready.positives:
        log.warning("no anomalous window among %d training rows", ready.rows)
    model = lr_fit(train)
    scored = model.transform(test)
    metrics = evaluator_metrics(scored)
    if model_path:
        save_model(model, model_path)
    return model, metrics, scored


def infer(spark: SparkSession, source, model: PipelineModel, path: str, checkpoint: str, seconds: float,
          windowing: Windowing = Windowing(), keep: Sequence[str] = (),
          interval: str | None = TRIGGER_INTERVAL) -> DataFrame:
    """Score closed windows of a live source for a while; returns the predictions so far."""
    trades = trade_stream(spark, source, keep)
    scored = stream_score(trades, model, windowing.size, windowing.slide, windowing.delay, windowing.order)
    run_for(run_to_parquet(scored, path, checkpoint, interval), seconds)
    return spark.read.parquet(path)
