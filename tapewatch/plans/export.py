"""Readable CSV exports of the stage outputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from tapewatch.operators.classify import prediction_view
from tapewatch.operators.runmetrics import read_event_log, run_summary
from tapewatch.sources.sinks import export_csv
from tapewatch.sources.tables import resolve_path


def export_windows(spark: SparkSession, sources: Sequence[str], target: str) -> bool:
    """Statistics or labelled windows: the first source folder that exists, sorted by window."""
    path = resolve_path(spark, sources)
    if path is None:
        return False
    export_csv(spark.read.parquet(path), target, order_by="window_start")
    return True


def export_predictions(spark: SparkSession, source: str, target: str) -> bool:
    path = resolve_path(spark, [source])
    if path is None:
        return False
    df = spark.read.parquet(path)
    export_csv(prediction_view(df) if "probability" in df.columns else df, target, order_by="window_start")
    return True


def export_runs(spark: SparkSession, logs: Sequence[str], target: str) -> None:
    """One row per run; small by nature, so one file."""
    export_csv(run_summary(read_event_log(spark, list(logs))), target, order_by="run", single_file=True)
