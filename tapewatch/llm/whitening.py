"""Whitening of embeddings along the principal components of their distinct vectors.

Vectors are taken to whole numbers, so equal ones are told exactly and their sums and deviations from the
mean are exact. The covariance is never formed: Jacobi-Davidson asks for its products with a few
columns, each one pass over blocks of vectors that adds up narrow rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewatch.llm.common import Scratch, as_binary, lean, table
from tapewatch.llm.jacobi_davidson import EPS, largest_eigenpairs

#: Entry c becomes floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
#: larger whole numbers count as this one, so that sums of a block fit 64 bits
LIMIT = 1 << 52
BLOCK_BYTES, BLOCK_ROWS = 1 << 20, 2048


def whole_vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which rows have a vector of finite entries, the length of each, and all entries of those rows as whole numbers."""
    n = len(column)
    offsets = column.offsets.to_numpy().astype(np.int64)
    entries = column.values.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    finite = np.isfinite(entries)
    bad = np.concatenate(([0], np.cumsum(~finite)))
    lengths = np.diff(offsets)
    good = column.is_valid().to_numpy(zero_copy_only=False) & (bad[offsets[1:]] == bad[offsets[:-1]])
    mine = np.zeros(len(entries) + 1, np.int64)
    np.add.at(mine, offsets[:-1][good], 1)
    np.add.at(mine, offsets[1:][good], -1)
    inside = np.cumsum(mine)[:-1] > 0
    whole = np.clip(np.floor(SCALE * entries[inside]), -LIMIT, LIMIT).astype(np.int64) + SHIFT
    return good, np.where(good, lengths, 0)[:n], whole


def _distinct(vectors: DataFrame, column: str) -> DataFrame:
    """``x binary, dims``: each vector of whole numbers once."""
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, lengths, whole = whole_vectors(batch.column(0))
            ends = np.cumsum(lengths[good])
            data, at = whole.tobytes(), np.concatenate(([0], 8 * ends)).tolist()
            yield pa.record_batch([as_binary([data[a:b] for a, b in zip(at, at[1:])]), pa.array(lengths[good])], ["x", "dims"])

    return vectors.select(column).mapInArrow(run, "x binary, dims long").distinct()


def _blocks(distinct: DataFrame, dims: int) -> DataFrame:
    """``data binary``: rows of equally long vectors side by side, about a megabyte each."""
    rows = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (8 * dims)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        for batch in batches:
            held.extend(batch.column(0).to_pylist())
            while len(held) >= rows:
                yield pa.record_batch([as_binary([b"".join(held[:rows])])], ["data"])
                held = held[rows:]
        if held:
            yield pa.record_batch([as_binary([b"".join(held)])], ["data"])

    return distinct.filter(F.col("dims") == dims).select("x").mapInArrow(run, "data binary")


def _sums(blocks: DataFrame, dims: int) -> tuple[int, list[int]]:
    """Number of vectors and the exact sum of each dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, total = 0, [0] * dims
        for batch in batches:
            for value in batch.column(0):
                x = np.frombuffer(value.as_buffer(), np.int64).reshape(-1, dims)
                rows += len(x)
                total = [a + b for a, b in zip(total, x.sum(axis=0).tolist())]
        yield pa.record_batch([pa.array(range(-1, dims), pa.int64()), pa.array([str(v) for v in [rows, *total]])], ["dim", "total"])

    # one row per dimension
    found = {r["dim"]: int(r["total"]) for r in blocks.mapInArrow(run, "dim long, total string").groupBy("dim")
             .agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()}
    return found.get(-1, 0), [found.get(j, 0) for j in range(dims)]


class Centre:
    """Mean of ``n`` vectors with the dimension sums ``sums``; differences from it without cancellation."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.dims = n, len(sums)
        self.floor = np.array([s // n for s in sums], np.int64)
        self.rest = np.array([s % n for s in sums], np.int64)
        self.part = np.array([s % n / n for s in sums])

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.floor) - self.part

    def deviations(self, x: np.ndarray) -> pa.Array:
        """Exact sums of ``(n * x - S) ** 2`` over the dimensions."""
        steps = x - self.floor
        largest = self.n * (int(np.abs(steps).max(initial=0)) + 1)
        if largest * largest * self.dims < 1 << 63:
            apart = self.n * steps - self.rest
            return pa.array((apart * apart).sum(axis=1)).cast(pa.decimal128(38, 0))
        apart = self.n * steps.astype(object) - self.rest.astype(object)
        totals = (apart * apart).sum(axis=1)
        return pa.array([None if t >= 10 ** 38 else t for t in totals.tolist()], pa.decimal128(38, 0))


def _total(blocks: DataFrame, centre: Centre, function: Callable[[np.ndarray], np.ndarray], length: int) -> np.ndarray:
    """Sum over all blocks of ``function(centred vectors)``, an array of ``length`` numbers.

    Each task adds up its blocks; the rows of all tasks are summed by slot, and a row per slot comes to the driver.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(length)
        for batch in batches:
            for value in batch.column(0):
                total += function(centre.centred(np.frombuffer(value.as_buffer(), np.int64).reshape(-1, centre.dims))).ravel()
        yield pa.record_batch([pa.array(np.arange(length)), pa.array(total)], ["slot", "value"])

    out = np.zeros(length)
    for row in blocks.mapInArrow(run, "slot long, value double").groupBy("slot").agg(F.sum("value").alias("value")).collect():
        out[row["slot"]] = row["value"]
    return out


def whiten(vectors: DataFrame, scratch: Scratch, id_column: str = "vec_id", vector_column: str = "embedding",
           components: int = COMPONENTS) -> DataFrame:
    """One row per vector and component: the id, ``component, n, deviation, whitened, explained, identity_error``.

    Rows whose vector is null or has null, NaN or infinite entries have no place and are left out; so are
    vectors that are not as long as most are (of two lengths the longer counts), as they share no covariance.
    Entries beyond 2^46 count as 2^46. Repeated vectors count once in the fit, and each of their rows is returned;
    null and repeated ids are rows of their own; other columns are ignored. Components without variance
    cannot be scaled and are left out, so one distinct vector, or none, gives no rows. ``deviation`` is null beyond
    38 digits.
    """
    spark = vectors.sparkSession
    narrow = vectors.select(F.col(f"`{id_column}`").alias("_row"), F.col(f"`{vector_column}`").alias("_vector"))
    id_type = narrow.schema["_row"].dataType.simpleString()
    schema = (f"`{id_column}` {id_type}, component int, n long, deviation decimal(38,0), whitened double, "
              "explained double, identity_error double")
    distinct = scratch.put(_distinct(narrow, "_vector"))
    commonest = distinct.groupBy("dims").count().orderBy(F.desc("count"), F.desc("dims")).first()
    if commonest is None or commonest["dims"] == 0:
        return spark.createDataFrame([], schema)
    dims = commonest["dims"]
    blocks = scratch.put(_blocks(distinct, dims))
    centre = Centre(*_sums(blocks, dims))
    n = centre.n

    def product(columns: np.ndarray) -> np.ndarray:
        return _total(blocks, centre, lambda x: x.T @ (x @ columns), columns.size).reshape(columns.shape) / n

    trace = _total(blocks, centre, lambda x: np.array([(x * x).sum()]), 1)[0] / n
    if trace == 0:
        return spark.createDataFrame([], schema)
    values, directions = largest_eigenpairs(product, dims, components)
    kept = values > 16 * dims * EPS * values[0]
    values, directions = values[kept], directions[:, kept]
    k, scaled = len(values), directions / np.sqrt(values)
    means = _total(blocks, centre, lambda x: (x @ scaled).sum(axis=0), k) / n

    def squares(x: np.ndarray) -> np.ndarray:
        apart = x @ scaled - means
        return apart.T @ apart

    error = float(np.abs(_total(blocks, centre, squares, k * k).reshape(k, k) / n - np.eye(k)).max())
    explained = values / trace

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, lengths, whole = whole_vectors(batch.column(1))
            right = lengths[good] == dims
            x = whole[np.repeat(right, lengths[good])].reshape(-1, dims)
            rows = np.flatnonzero(good)[right]
            each = pa.array(np.repeat(np.arange(len(rows)), k))
            size = len(rows) * k
            yield pa.record_batch(
                [batch.column(0).take(pa.array(rows)).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                 pa.array(np.full(size, n, np.int64)), centre.deviations(x).take(each), pa.array((centre.centred(x) @ scaled).ravel()),
                 pa.array(np.tile(explained, len(rows))), pa.array(np.full(size, error))],
                [id_column, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return narrow.mapInArrow(run, schema)


def op11_whiten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of ``embeddings`` on its first 16 components; ``deviation`` is null where a long cannot hold it."""
    scratch = Scratch(spark, "op11")
    rows = whiten(table(spark, sf_dir, "embeddings"), scratch)
    return scratch.finish(rows.withColumn("deviation", F.expr("try_cast(deviation AS bigint)")))
