"""Packing documents into sequences along a space-filling curve through hashed document vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapewatch.llm.common import Scratch, lean, mix64, table
from tapewatch.llm.tokens import default_tokenizer, id_bytes, split_batch, vocabulary, word_encoder

SEQUENCE = 4096
DIMENSIONS, BITS = 4, 8


def hilbert_key(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Position on the Hilbert curve of integer points (one row each) below ``2 ** bits``.

    Works from the highest bit down: each coordinate with the bit set inverts the lower bits of the
    first, each without it swaps its lower bits with the first's; a Gray code then gives the order.
    """
    x = [points[:, d].astype(np.int64) for d in range(points.shape[1])]
    for level in range(bits - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for d in range(len(x)):
            on = (x[d] & bit) != 0
            swap = np.where(on, 0, (x[0] ^ x[d]) & low)
            x[0] = np.where(on, x[0] ^ low, x[0] ^ swap)
            x[d] = x[d] ^ swap if d else x[0]
    for d in range(1, len(x)):
        x[d] = x[d] ^ x[d - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] & (1 << level)) != 0, (1 << level) - 1, 0)
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for d in range(len(x)):
            key = (key << 1) | (((x[d] ^ flip) >> level) & 1)
    return key


def curve_keys(ids: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Each document's bag of ids under a random sign projection to few dimensions, as a curve position."""
    n = np.diff(offsets)
    signs = mix64(np.arange(int(ids.max(initial=0)) + 1, dtype=np.uint64))
    points = np.zeros((len(n), DIMENSIONS), np.int64)
    for d in range(DIMENSIONS):
        sign = ((signs >> np.uint64(d)) & np.uint64(1)).astype(np.int64) * 2 - 1
        mean = np.add.reduceat(sign[ids], offsets[:-1]) / n
        points[:, d] = np.clip((np.tanh(3 * mean) + 1) * (1 << (BITS - 1)), 0, (1 << BITS) - 1)
    return hilbert_key(points)


def _encode(docs: DataFrame, tokenizer: str, end_id: int, width: str) -> DataFrame:
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer, end_id)
        for batch in batches:
            for lo, hi in split_batch(batch.column(1)):
                ids, at = encoder.encode(batch.column(1).slice(lo, hi - lo))
                yield pa.record_batch(
                    [batch.column(0).slice(lo, hi - lo), pa.array(np.diff(at)), pa.array(curve_keys(ids, at)),
                     id_bytes(ids, at, width).cast(pa.binary())], ["doc_id", "doc_tokens", "curve", "ids"])
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(run, "doc_id long, doc_tokens long, curve long, ids binary")
            .withColumn("row", F.monotonically_increasing_id()))


def _positions(tokens: DataFrame, scratch: Scratch) -> DataFrame:
    """``row, begin``: the tokens before each document along the curve.

    Narrow rows are range-partitioned by curve position and sorted, each partition sums its own, and a
    running sum over one row per partition gives where each begins.
    """
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.column(1).to_numpy()
            ends = before + np.cumsum(n)
            if len(n):
                yield pa.record_batch([batch.column(0), pa.array(np.full(len(n), part, np.int64)), pa.array(ends - n),
                                       batch.column(1)], ["row", "part", "begin", "n"])
                before = int(ends[-1])

    order = ["curve", F.col("doc_id").asc_nulls_last(), "row"]
    placed = scratch.put(tokens.select("row", "doc_tokens", "curve", "doc_id")
                         .repartitionByRange(*order).sortWithinPartitions(*order).select("row", "doc_tokens")
                         .mapInArrow(run, "row long, part long, begin long, n long"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = (placed.groupBy("part").agg(F.sum("n").alias("_n"))
             .select("part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base")))
    return placed.join(bases, "part").select("row", (F.col("begin") + F.col("_base")).alias("begin"))


def tail_cuts(total: int, size: int) -> np.ndarray:
    """Ends of the sequences of what is left after the full ones: powers of two, so that none is padded."""
    rest, at, ends = total % size, total - total % size, []
    for level in range(size.bit_length() - 1, -1, -1):
        if rest >> level & 1:
            at += 1 << level
            ends.append(at)
    return np.array(ends, np.int64)


def pack(docs: DataFrame, scratch: Scratch, size: int = SEQUENCE, tokenizer: str | None = None,
         end_id: int = 2) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``.

    Documents follow each other along the curve, so a sequence holds documents of like wording; the
    stream is cut every ``size`` ids and its end into powers of two, so nothing is padded. ``ids`` are
    little-endian unsigned 32-bit numbers. Null text is empty and still has its end id. Null and
    repeated ids are documents of their own; other columns are ignored; no rows give no pieces.
    """
    tokenizer = tokenizer or default_tokenizer()
    width, _ = vocabulary(docs.sparkSession, tokenizer)
    tokens = scratch.put(_encode(docs, tokenizer, end_id, width))
    positions = scratch.put(_positions(tokens, scratch))
    total = tokens.agg(F.coalesce(F.sum("doc_tokens"), F.lit(0)).alias("n")).first()["n"]
    full, tail = total - total % size, tail_cuts(total, size)

    @lean
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: dict[str, list] = {c: [] for c in ("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")}
            for doc_id, n, value, begin in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2),
                                               batch.column(3).to_pylist()):
                ids = np.frombuffer(value.as_buffer(), width).astype("<u4")
                ends = np.arange((begin // size + 1) * size, min(begin + n, full) + size, size)
                ends = np.concatenate((ends[ends <= full], tail[tail > begin]))
                at = begin
                for end in ends.tolist():
                    if at >= begin + n:
                        break
                    stop = min(end, begin + n)
                    if at < full:
                        sequence, first = at // size, at // size * size
                    else:
                        k = int(np.searchsorted(tail, at, side="right"))
                        sequence, first = full // size + k, int(tail[k - 1]) if k else full
                    for name, v in (("doc_id", doc_id), ("start", at - begin), ("length", stop - at),
                                    ("ids", ids[at - begin:stop - begin].tobytes()), ("doc_tokens", n),
                                    ("sequence_id", sequence), ("offset", at - first)):
                        rows[name].append(v)
                    at = stop
            yield pa.record_batch([pa.array(v, pa.binary() if c == "ids" else pa.int64()) for c, v in rows.items()], list(rows))

    # both sides grow with the input, so the same join at every size
    return (tokens.hint("merge").join(positions, "row").select("doc_id", "doc_tokens", "ids", "begin")
            .mapInArrow(cut, "doc_id long, start long, length long, ids binary, doc_tokens long, "
                             "sequence_id long, offset long"))


def op9_pack_along_curve(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """All pieces of all documents, with the checksum of their ids."""
    scratch = Scratch(spark, "op9")
    pieces = pack(table(spark, sf_dir, "documents"), scratch, tokenizer=tokenizer)
    return scratch.finish(pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                                        "sequence_id", "offset"))
