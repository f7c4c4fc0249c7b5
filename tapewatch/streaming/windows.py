"""Windows over live trades: exact ones from state, or per-batch fragments."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapewatch.operators.classify import score
from tapewatch.operators.ordering import ArrivalOrder
from tapewatch.operators.windows import window_features, window_stats
from tapewatch.schema import WATERMARK_DELAY, WINDOW_SIZE, WINDOW_SLIDE
from tapewatch.sources.published import publish_batch
from tapewatch.sources.trades import decode_checked

log = logging.getLogger(__name__)

# Partition and offset order trades within a millisecond; any of them fit one decimal with windows of up to 14 days.
BROKER_ORDER = ArrivalOrder("event_time", ("partition", "offset"), tick_us=1_000)


def with_watermark(trades: DataFrame, delay: str = WATERMARK_DELAY) -> DataFrame:
    return trades.withWatermark("event_time", delay)


def stream_window_stats(trades: DataFrame, size: str = WINDOW_SIZE, slide: str = WINDOW_SLIDE,
                        delay: str = WATERMARK_DELAY, order: ArrivalOrder = ArrivalOrder()) -> DataFrame:
    """One final row per (symbol, window), emitted when the watermark passes the window's end.

    A trade is late for the windows that end before the watermark of the batch before its own; it
    still counts in the windows that overlap them and end later. Windows still open when the stream stops stay in the state: they come out after a
    restart, and ``open_windows`` reads them before.
    """
    return window_stats(with_watermark(trades, delay), size, slide, order=order)


def stream_score(trades: DataFrame, model: PipelineModel, size: str = WINDOW_SIZE,
                 slide: str = WINDOW_SLIDE, delay: str = WATERMARK_DELAY,
                 order: ArrivalOrder = ArrivalOrder()) -> DataFrame:
    """Predictions for closed windows; the model's parameters are part of the plan."""
    return score(window_features(stream_window_stats(trades, size, slide, delay, order)), model)


def _per_batch(trades: DataFrame, size: str, slide: str, order: ArrivalOrder) -> DataFrame:
    return window_features(window_stats(trades, size, slide, order=order, bounds_of_order=True))


def fragment_writer(path: str, size: str = WINDOW_SIZE, slide: str = WINDOW_SLIDE,
                    order: ArrivalOrder = ArrivalOrder()) -> Callable[[DataFrame, int], None]:
    """Callback that publishes each micro-batch's partial windows under its ``batch_id``; ``read_published`` reads them.

    Late trades are never dropped here. Merge the fragments to get exact windows.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            log.info("published %s", publish_batch(_per_batch(batch, size, slide, order), path, batch_id).folder)
    return write


def fragment_scorer(model: PipelineModel, path: str, size: str = WINDOW_SIZE, slide: str = WINDOW_SLIDE,
                    order: ArrivalOrder = ArrivalOrder()) -> Callable[[DataFrame, int], None]:
    """Callback that scores each micro-batch's partial windows as they are and publishes them."""
    def write(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            scored = score(_per_batch(batch, size, slide, order), model)
            log.info("published %s", publish_batch(scored, path, batch_id).folder)
    return write


def message_writer(path: str, keep: Sequence[str] = ()) -> Callable[[DataFrame, int], None]:
    """Callback for raw messages: decodes each once and publishes trades and dead letters in one table, which
    ``trades_of`` and ``dead_letters`` part again."""
    def write(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            log.info("published %s", publish_batch(decode_checked(batch, keep=keep), path, batch_id).folder)
    return write


def closed_windows(stats: DataFrame, trades: DataFrame, delay_seconds: int) -> DataFrame:
    """Batch windows that a stream over the same trades has emitted by its end."""
    mark = trades.select((F.max(F.unix_micros("event_time")) / 1000).cast("long")
                         - F.lit(delay_seconds * 1000)).scalar()
    return stats.filter(F.unix_millis("window_end") <= mark)
