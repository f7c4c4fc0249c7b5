"""Percentiles that hold neither all values nor all distinct values in one place.

Sketches are Spark's KLL sketches: kept per day or batch, merged later, asked for any percentile. They
answer within a stated rank error, and they bracket the search for exact percentiles.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewatch.functions.scalars import order_code
from tapewatch.schema import FALLBACK_THRESHOLD
from tapewatch.session import settle
from tapewatch.sources.published import publish_batch, read_published

#: size of a sketch: the number of values in its largest compactor
SKETCH_SIZE = 8_192
#: cells that one round of the search cuts a range of codes into
CELLS = 1_024


def rank_error(size: int = SKETCH_SIZE) -> float:
    """Share of all rows by which the rank of an answer may be off, at 99 % confidence, however many sketches were merged."""
    return 2.296 / size ** 0.9723  # fixed values: the error of this kind of sketch


def _sketch_size(accuracy: int) -> int:
    """A sketch whose rank error is about ``1 / accuracy`` or less."""
    return min(max(math.ceil((2.296 * accuracy) ** (1 / 0.9723)), 8), 65_535)


def _numbers(column: str) -> Column:
    """Values that take part: not null and not NaN."""
    v = F.col(column).cast("double")
    return F.when(~F.isnan(v), v)


def sketch_values(df: DataFrame, column: str, by: Sequence[str] = (), size: int = SKETCH_SIZE) -> DataFrame:
    """A sketch of the values of each group, ``sketch`` with their number ``n``; one pass, small rows in the shuffle."""
    v = df.withColumn("_v", _numbers(column))
    return v.groupBy(*by).agg(F.kll_sketch_agg_double("_v", size).alias("sketch"), F.count("_v").alias("n"))


def merge_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketches of the same size joined into one per group; an empty one adds nothing."""
    return sketches.filter("n > 0").groupBy(*by).agg(F.kll_merge_agg_double("sketch").alias("sketch"), F.sum("n").alias("n"))


def sketch_percentile(sketches: DataFrame, q: float | Sequence[float]) -> list[float] | None:
    """Percentiles of all rows behind the sketches, off by ``rank_error`` at most; None when there are no rows."""
    qs = [q] if isinstance(q, (int, float)) else list(q)
    wanted = F.array(*[F.lit(float(min(max(x, 0.0), 1.0))) for x in qs])
    row = merge_sketches(sketches).filter("n > 0").select(F.kll_sketch_get_quantile_double("sketch", wanted).alias("v")).first()
    return None if row is None else list(row["v"])


def sketch_writer(path: str, column: str, size: int = SKETCH_SIZE) -> Callable[[DataFrame, int], None]:
    """Callback that publishes a sketch of each micro-batch; a retried batch replaces its own."""
    def write(batch: DataFrame, batch_id: int) -> None:
        publish_batch(sketch_values(batch, column, size=size), path, batch_id)
    return write


def stream_threshold(spark: SparkSession, path: str, q: float) -> float:
    """The percentile over all batches published so far; the fallback when they had no values."""
    found = sketch_percentile(read_published(spark, path), q)
    return FALLBACK_THRESHOLD if found is None else found[0]


def _values_at(inside: DataFrame, ranks: set[int], low: int, high: int) -> dict[int, float]:
    """The values that hold 0-based ranks of a table of values with counts ``n`` and codes from ``low`` to ``high``.

    A round cuts the range of codes into cells and goes on inside the cells of the ranks, until they hold one
    value: seven rounds at most, as codes have 64 bits, and usually one or two.
    """
    width = max(1, -(-(high - low + 1) // CELLS))
    kind = "bigint" if high - low < 1 << 62 else "decimal(38,0)"
    cell = F.expr(f"(CAST(code AS {kind}) - CAST('{low}' AS {kind})) div CAST('{width}' AS {kind})")
    cells = (inside.filter(F.col("code").between(low, high)).groupBy(cell.alias("cell"))
             .agg(F.sum("n").alias("n"), F.min("code").alias("lo"), F.max("code").alias("hi"), F.min("v").alias("v"))
             .orderBy("lo").collect())  # a row per cell
    found, below = {}, 0
    for c in cells:
        mine = {r for r in ranks if below <= r < below + c["n"]}
        if mine and c["lo"] == c["hi"]:
            found |= {r: c["v"] for r in mine}
        elif mine:
            deeper = _values_at(inside, {r - below for r in mine}, c["lo"], c["hi"])
            found |= {r + below: v for r, v in deeper.items()}
        below += c["n"]
    return found


def exact_percentiles(df: DataFrame, column: str, qs: Sequence[float], accuracy: int = 10_000,
                      sketches: DataFrame | None = None) -> list[float] | None:
    """Interpolated percentiles of the values that are neither null nor NaN, equal to ``percentile(column, q)``.

    Two scans of ``df`` at any size: a sketch (or given ``sketches`` of the same rows) brackets each rank, then
    one pass counts what is below each bracket and keeps the distinct values inside, some ``16 / accuracy`` of the rows; in
    that small table the rank is found by cells of the values' order codes. Only if a bracket misses its rank, which
    happens about once in millions of times, a wider one takes another scan. None without values.
    """
    size = _sketch_size(accuracy)
    values = df.select(_numbers(column).alias("v")).filter("v IS NOT NULL")
    merged = merge_sketches(sketches if sketches is not None else sketch_values(values, "v", size=size))
    margin = 4 * (rank_error(size) if sketches is None else 1.0 / accuracy)
    found, pending = {}, {q: None for q in qs}
    while pending:
        cuts = [min(max(q + s * margin, 0.0), 1.0) for q in pending for s in (-1, 1)]
        row = merged.filter("n > 0").select(
            "n", F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(float(c)) for c in cuts])).alias("v")).first()
        if row is None:
            return None
        n, bounds = row["n"], row["v"]
        for i, q in enumerate(pending):
            # a bracket that reaches the end of the ranks is open there
            pending[q] = (-math.inf if cuts[2 * i] <= 0 else bounds[2 * i], math.inf if cuts[2 * i + 1] >= 1 else bounds[2 * i + 1])
        spans = F.array(*[F.struct(F.lit(float(q)).alias("q"), F.lit(lo).alias("lo"), F.lit(hi).alias("hi")) for q, (lo, hi) in pending.items()])
        side = F.when(F.col("v") < F.col("s.lo"), -1).when(F.col("v") <= F.col("s.hi"), 0)
        inside = settle(values.select("v", F.explode(spans).alias("s")).withColumn("side", side).filter("side IS NOT NULL")
                        .groupBy("s.q", "side", F.when(F.col("side") == 0, F.col("v")).alias("v")).agg(F.count(F.lit(1)).alias("n"))
                        .withColumn("code", order_code("v")), "bracket")
        # a row per percentile
        totals = {r["q"]: r for r in inside.groupBy("q").agg(
            F.coalesce(F.sum(F.when(F.col("side") == -1, F.col("n"))), F.lit(0)).alias("under"),
            F.coalesce(F.sum(F.when(F.col("side") == 0, F.col("n"))), F.lit(0)).alias("held"),
            F.min("code").alias("lo"), F.max("code").alias("hi")).collect()}
        for q in list(pending):
            position, t = q * (n - 1), totals.get(q)
            ranks = {math.floor(position), math.ceil(position)}
            if t is None or min(ranks) < t["under"] or max(ranks) >= t["under"] + t["held"]:
                continue
            mine = inside.filter((F.col("q") == q) & (F.col("side") == 0))
            at = _values_at(mine, {r - t["under"] for r in ranks}, t["lo"], t["hi"])
            low, high = min(ranks), max(ranks)
            first, last = at[low - t["under"]], at[high - t["under"]]
            found[q] = first if first == last else (high - position) * first + (position - low) * last
            del pending[q]
        margin *= 4
    return [found[q] for q in qs]


def exact_percentile(df: DataFrame, column: str, q: float, accuracy: int = 10_000,
                     sketches: DataFrame | None = None) -> float | None:
    """One of ``exact_percentiles``."""
    found = exact_percentiles(df, column, [q], accuracy, sketches)
    return None if found is None else found[0]


def percentile_threshold(df: DataFrame, column: str, q: float, exact: bool = True,
                         accuracy: int = 10_000) -> float:
    """Threshold for labelling; 1.0 when there is no value to take a percentile of.

    ``exact=False`` is one pass with a rank error of at most 1 / accuracy.
    """
    if exact:
        found = exact_percentile(df, column, q, accuracy)
    else:
        found = df.agg(F.percentile_approx(column, q, accuracy)).first()[0]
    return FALLBACK_THRESHOLD if found is None else float(found)
