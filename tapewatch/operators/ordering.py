"""Order-sensitive building blocks that never put one symbol into one task."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapewatch.functions.scalars import LARGEST_CODE, order_code
from tapewatch.operators.lookup import lookup
from tapewatch.session import settle

_IN_PARTITION = (1 << 33) - 1
_LONG, _DECIMAL = (1 << 63) - 1, 10**38 - 1
_BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}
_FLOATING = (T.FloatType, T.DoubleType)


def _code(df: DataFrame, column: str) -> Column:
    """A column as whole numbers in its order."""
    return order_code(column) if isinstance(df.schema[column].dataType, _FLOATING) else F.col(column)


@dataclass(frozen=True)
class ArrivalOrder:
    """What "first" and "last" mean inside a window: event time, then the tie-break columns.

    Time counts in steps of ``tick_us`` microseconds. Whole-number tie-breaks, floating ones by their
    ``order_code``, and the time in the window are packed into one number, a long or a decimal, by what their
    column types can hold, so that the aggregation is a hash aggregation for any values, null ones (first of
    all) included. An order that does not fit in 38 digits by type, or has other tie-breaks, is a struct: same rows,
    sorted aggregation.
    ``ranges`` narrows what the types say to (least value, number of values) per tie-break.
    """

    time: str = "event_time"
    tiebreak: tuple[str, ...] = ("price",)
    tick_us: int = 1
    ranges: tuple[tuple[int, int], ...] | None = None

    def measured(self, df: DataFrame) -> ArrivalOrder:
        """With the ranges that a static table holds: one pass over the (pruned) tie-break columns. Only orders of whole
        numbers are narrowed."""
        if self.ranges is not None or any(type(df.schema[c].dataType) not in _BITS for c in self.tiebreak):
            return self
        aggs = [agg for i, c in enumerate(self.tiebreak) for agg in (F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}"))]
        bounds = df.agg(*aggs).first() if aggs else None
        return replace(self, ranges=tuple((bounds[f"lo{i}"] or 0, (bounds[f"hi{i}"] or 0) - (bounds[f"lo{i}"] or 0) + 1)
                                          for i in range(len(self.tiebreak))))

    def _ranges(self, df: DataFrame, columns: Sequence[str] | None = None) -> tuple[tuple[int, int], ...] | None:
        if self.ranges is not None:
            return self.ranges
        kinds = [type(df.schema[c].dataType) for c in columns or self.tiebreak]
        if not all(k in _BITS or k in _FLOATING for k in kinds):
            return None
        return tuple((-LARGEST_CODE, 2 * LARGEST_CODE + 1) if k in _FLOATING else (-(1 << (_BITS[k] - 1)), 1 << _BITS[k]) for k in kinds)

    def step(self, column: Column | str) -> Column:
        """A time as a number of ticks."""
        micros = F.unix_micros(F.col(column) if isinstance(column, str) else column)
        return micros if self.tick_us == 1 else F.floor(micros / F.lit(self.tick_us)).cast("long")

    def rank(self) -> Column:
        """The order itself, of rows of any times."""
        return F.struct(self.step(self.time).alias("at"), *self.tiebreak)

    def key(self, df: DataFrame, window_start: Column, span_us: int, time: str | None = None,
            tiebreak: Sequence[str] | None = None) -> Column:
        """Sort key of a row of ``df`` within its window of ``span_us`` microseconds; ``time`` and ``tiebreak`` are the
        columns that hold them, if they go by other names there."""
        time, tiebreak = time or self.time, tuple(tiebreak or self.tiebreak)
        if not tiebreak:
            return self.step(time)
        ranges = self._ranges(df, tiebreak)
        steps = span_us // self.tick_us + 2
        size = steps
        for _, values in ranges or ():
            size *= values + 1
        if ranges is None or size > _DECIMAL:
            return F.struct(self.step(time).alias("at"), *tiebreak)
        kind = "long" if size <= _LONG else "decimal(38,0)"
        whole = lambda n: F.expr(f"CAST('{n}' AS {kind})")
        packed = (self.step(time) - self.step(window_start)).cast(kind)
        for c, (least, values) in zip(tiebreak, ranges):
            code = F.coalesce((_code(df, c).cast(kind) + whole(1 - least)).cast(kind), whole(0))
            packed = (packed * whole(values + 1) + code).cast(kind)
        return packed


def _by_range(df: DataFrame, order: Sequence[Column | str], partitions: int | None) -> DataFrame:
    """Rows in order. The range bounds come from a sample, so ``df`` is read twice and should be a table.

    Without a fixed number of partitions adaptive execution fits it to the data.
    """
    fixed = (partitions,) if partitions else ()
    return df.repartitionByRange(*fixed, *order).sortWithinPartitions(*order)


def global_index(df: DataFrame, order: Sequence[Column | str], name: str = "row_index",
                 partitions: int | None = None) -> DataFrame:
    """Number all rows 0, 1, 2, … in the given order.

    Rows are range-partitioned on the full order, so a hot key spreads over as many tasks as its
    rows need; the only single-task step adds up one count per partition.
    """
    placed = settle(
        _by_range(settle(df, "unordered"), order, partitions)
        .withColumn("_slot", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright(F.col("_slot"), 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    # at most one row per range partition, so the broadcast is bounded by n
    return (placed.withColumn("_part", part)
            .join(F.broadcast(offsets), "_part")
            .withColumn(name, F.col("_offset") + F.col("_slot").bitwiseAND(F.lit(_IN_PARTITION)))
            .drop("_part", "_slot", "_offset"))


def keyed_index(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "row_index",
                partitions: int | None = None) -> DataFrame:
    """Number the rows of each key 0, 1, 2, …; a dense row_number without per-key tasks."""
    indexed = global_index(df, [*keys, *order], "_global", partitions)
    firsts = indexed.groupBy(*keys).agg(F.min("_global").alias("_first"))
    return (lookup(indexed, firsts, keys)
            .withColumn(name, F.col("_global") - F.col("_first"))
            .drop("_global", "_first"))


def trailing_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int,
                  aggregates: dict[str, Column], block: int = 4096,
                  partitions: int | None = None) -> DataFrame:
    """Aggregates over the n rows before each row of its key.

    Each key is cut into blocks of at least n rows and a block also sees the last n rows of the
    one before, so a task holds at most block + n rows of a key and no frame is cut short.
    """
    block = max(block, n)
    indexed = keyed_index(df, keys, order, "_idx", partitions)
    home = (F.col("_idx") / F.lit(block)).cast("long")
    place = F.col("_idx") % F.lit(block)
    copies = F.when(place >= block - n, F.array(home, home + 1)).otherwise(F.array(home))
    spread = indexed.withColumn("_home", home).withColumn("_block", F.explode(copies))
    frame = Window.partitionBy(*keys, "_block").orderBy("_idx").rowsBetween(-n, -1)
    out = spread.withColumns({name: agg.over(frame) for name, agg in aggregates.items()})
    return out.filter(F.col("_block") == F.col("_home")).drop("_idx", "_home", "_block")


def running_total(df: DataFrame, order: Sequence[str], values: Sequence[str],
                  partitions: int | None = None) -> DataFrame:
    """Adds ``<value>_before``: the sum of each value over all rows earlier in the order."""
    placed = settle(_by_range(settle(df, "unordered"), order, partitions)
                    .withColumn("_slot", F.monotonically_increasing_id())
                    .withColumn("_part", F.shiftright(F.col("_slot"), 33)), "ordered")
    sums = placed.groupBy("_part").agg(*[F.sum(v).alias(f"_s_{v}") for v in values])
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_part", *[F.coalesce(F.sum(f"_s_{v}").over(before), F.lit(0)).alias(f"_o_{v}")
                                     for v in values])
    inside = Window.partitionBy("_part").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    out = placed.withColumns({f"{v}_before": F.coalesce(F.sum(v).over(inside), F.lit(0)) for v in values})
    # at most one row per range partition, so the broadcast is bounded by n
    out = out.join(F.broadcast(offsets), "_part")
    out = out.withColumns({f"{v}_before": F.col(f"{v}_before") + F.col(f"_o_{v}") for v in values})
    return out.drop("_part", "_slot", *[f"_o_{v}" for v in values])


def last_n(df: DataFrame, keys: Sequence[str], order: ArrivalOrder, n: int, salts: int = 64) -> DataFrame:
    """The newest n rows of each key.

    Hourly counts give each key the hour from which on its newest n rows lie, and only rows from
    there are ranked. Ranking takes two rounds, first within (key, salt), then across salts, so
    even an hour holding most of the data is spread out and the last round sees at most salts * n
    rows of a key.
    """
    at = F.coalesce(F.col(order.time), F.timestamp_micros(F.lit(-(1 << 55))))
    hour = F.date_trunc("hour", at)
    counted = df.groupBy(*keys, hour.alias("_hour")).agg(F.count(F.lit(1)).alias("_n"))
    later = Window.partitionBy(*keys).orderBy(F.desc("_hour")).rowsBetween(Window.unboundedPreceding, -1)
    needed = counted.withColumn("_later", F.coalesce(F.sum("_n").over(later), F.lit(0))).filter(F.col("_later") < n)
    since = needed.groupBy(*keys).agg(F.min("_hour").alias("_since"))
    ranked = lookup(df, since, keys).filter(at >= F.col("_since")).drop("_since")
    columns = [order.time, *order.tiebreak]
    newest_first = [F.col(c).desc() for c in columns]
    ranked = ranked.withColumn("_salt", F.pmod(F.xxhash64(*columns), F.lit(salts)))
    for scope in ([*keys, "_salt"], list(keys)):
        rank = F.row_number().over(Window.partitionBy(*scope).orderBy(*newest_first))
        ranked = ranked.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")
    return ranked.drop("_salt")


def extreme_by(df: DataFrame, keys: Sequence[str], value: str, order: ArrivalOrder,
               last: bool = True) -> DataFrame:
    """``value`` of the first or last row of each key, with its time.

    Rows are first reduced per key and day, where the order packs into a number and hash
    aggregation works; only those few rows are compared by the full order.
    """
    pick_by, pick = (F.max_by, F.max) if last else (F.min_by, F.min)
    day = F.date_trunc("day", F.col(order.time))
    framed = df.withColumn("_day", day)
    # a column, so that it is worked out once for all aggregates
    daily = (framed.withColumn("_arrival", order.key(framed, F.col("_day"), 86_400_000_000)).groupBy(*keys, "_day")
             .agg(pick_by(value, "_arrival").alias(value), pick(order.time).alias("_at")))
    return (daily.groupBy(*keys)
            .agg(pick_by(value, "_at").alias(value), pick("_at").alias(order.time)))
