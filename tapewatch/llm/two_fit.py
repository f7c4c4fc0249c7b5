"""Best-two-fit packing: a sequence takes the longest pieces that fit, then two for its shortest where that fills it better.

Lengths are whole numbers up to the size of a sequence, so the plan is made for the number of pieces of
each length, at most ``size`` numbers however many documents there are. A filling that fits the next
sequences too is taken as often as its lengths last, which gives what filling one sequence after the
other gives. Documents only learn which of the pieces of their length they are.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapewatch.llm.common import Scratch, lean, table
from tapewatch.llm.tokens import default_tokenizer, id_bytes, split_batch, word_encoder

SEQUENCE = 2048


def _greedy(lengths: list[int], counts: dict[int, int], size: int) -> tuple[Counter, int]:
    """The longest that fits, again and again; the lengths taken and the gap that stays."""
    used, gap = Counter(), size
    i = bisect_right(lengths, gap) - 1
    while i >= 0:
        n = min(gap // lengths[i], counts[lengths[i]])
        if n:
            used[lengths[i]] = n
            gap -= n * lengths[i]
        i = min(i - 1, bisect_right(lengths, gap) - 1)
    return used, gap


def _best_pair(free: np.ndarray, twice: np.ndarray, room: int) -> tuple[int, int] | None:
    """Two of the ascending lengths ``free`` with the largest sum up to ``room``, the longer one as long as it can be;
    one with ``twice`` may be both."""
    partner = np.searchsorted(free, room - free, side="right") - 1
    partner = np.minimum(partner, np.arange(len(free)))
    partner -= (partner == np.arange(len(free))) & ~twice
    fits = np.flatnonzero(partner >= 0)
    if not len(fits):
        return None
    sums = free[fits] + free[partner[fits]]
    at = fits[len(sums) - 1 - int(np.argmax(sums[::-1]))]
    return int(free[at]), int(free[partner[at]])


def _two_for_one(used: Counter, gap: int, counts: dict[int, int], lengths: list[int]) -> int:
    """Replace the shortest piece of a filling by two free ones while that leaves a smaller gap; the last gap."""
    while gap and sum(used.values()) > 1:
        shortest = min(used)
        room = gap + shortest
        used[shortest] -= 1
        left = np.array([counts[n] - used[n] for n in lengths[:bisect_right(lengths, room)]], np.int64)
        free = np.array(lengths[:len(left)], np.int64)
        pair = _best_pair(free[left > 0], left[left > 0] > 1, room)
        if pair is None or sum(pair) <= shortest:
            used[shortest] += 1
            return gap
        used.update(pair)
        used += Counter()
        gap = room - sum(pair)
    return gap


def fillings(counts: dict[int, int], size: int) -> Iterator[tuple[Counter, int]]:
    """``(pieces of each length, how many sequences are filled so)`` until no piece is left.

    Each filling uses some length up to less than it takes of it, so there are fewer than the sum of
    ``size / length`` over all lengths.
    """
    counts = {n: c for n, c in counts.items() if c}
    lengths = sorted(counts)
    while lengths:
        used, gap = _greedy(lengths, counts, size)
        _two_for_one(used, gap, counts, lengths)
        times = min(counts[n] // u for n, u in used.items())
        for n, u in used.items():
            counts[n] -= u * times
            if not counts[n]:
                lengths.remove(n)
        yield used, times


class Plan:
    """Where the pieces of each length go: piece number ``rank`` of a length to a sequence and a place in it."""

    def __init__(self, counts: dict[int, int], size: int):
        before, total = np.zeros(size + 2, np.int64), 0
        for n in range(1, size + 1):
            before[n] = total
            total += counts.get(n, 0)
        taken, rows, sequence = Counter(), [], 0
        for used, times in fillings(counts, size):
            offset = 0
            for n in sorted(used, reverse=True):
                rows.append((before[n] + taken[n], used[n], sequence, offset))
                taken[n] += used[n] * times
                offset += n * used[n]
            sequence += times
        self.before, self.sequences = before, sequence
        self.first, self.uses, self.sequence, self.offset = np.array(sorted(rows), np.int64).reshape(-1, 4).T.copy()

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = self.before[length] + rank
        row = np.searchsorted(self.first, at, side="right") - 1
        nth = at - self.first[row]
        return self.sequence[row] + nth // self.uses[row], self.offset[row] + nth % self.uses[row] * length

    def column(self, length: Column, rank: Column) -> Column:
        plan = self

        @F.pandas_udf("sequence_id long, offset long")
        def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
            sequence, offset = plan.place(length.to_numpy(np.int64), rank.to_numpy(np.int64))
            return pd.DataFrame({"sequence_id": sequence, "offset": offset})

        return place(length, rank)


def _turns(values: np.ndarray) -> np.ndarray:
    """How many equal values stand before each."""
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    starts = np.flatnonzero(np.diff(ordered, prepend=ordered[:1] - 1))
    turns = np.empty(len(values), np.int64)
    turns[order] = np.arange(len(values)) - np.repeat(starts, np.diff(starts, append=len(values)))
    return turns


def _pieces(docs: DataFrame, size: int, tokenizer: str, end_id: int, keep_ids: bool) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, part, nth`` and maybe ``ids``; ``nth`` counts the earlier pieces of the
    same length in the same task."""
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = word_encoder(tokenizer, end_id), TaskContext.get().partitionId()
        seen = np.zeros(size + 1, np.int64)
        for batch in batches:
            for lo, hi in split_batch(batch.column(1)):
                ids, at = encoder.encode(batch.column(1).slice(lo, hi - lo))
                ids = ids.astype("<u4")
                n = np.diff(at)
                parts = -(-n // size)
                doc = np.repeat(np.arange(len(n)), parts)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
                start = piece * size
                length = np.minimum(size, n[doc] - start)
                begins = np.append(at[doc] + start, at[-1])
                view = memoryview(ids).cast("B")
                crc = [zlib.crc32(view[4 * a:4 * b]) for a, b in zip(begins.tolist(), begins[1:].tolist())]
                nth = seen[length] + _turns(length)
                seen += np.bincount(length, minlength=size + 1)
                columns = [batch.column(0).slice(lo, hi - lo).take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start),
                           pa.array(length), pa.array(np.array(crc, np.int64)), pa.array(np.full(len(doc), part, np.int64)), pa.array(nth)]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"]
                if keep_ids:
                    columns.append(id_bytes(ids, begins, "<u4").cast(pa.binary()))
                    names.append("ids")
                yield pa.record_batch(columns, names)

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, part long, nth long"
                             + (", ids binary" if keep_ids else "")))


def pack(docs: DataFrame, scratch: Scratch, size: int = SEQUENCE, tokenizer: str | None = None, end_id: int = 0,
         keep_ids: bool = True) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` and ``ids`` if kept.

    A document longer than ``size`` ids is cut into pieces of ``size``, of which the last may be shorter; every
    other document is one piece. ``ids`` are little-endian unsigned 32-bit numbers. Null text is empty and
    still has its end id. Null and repeated ids are documents of their own; other columns are ignored;
    no rows give no pieces. Sequences are numbered from 0 without gaps.
    """
    pieces = scratch.put(_pieces(docs, size, tokenizer or default_tokenizer(), end_id, keep_ids))
    found = scratch.put(pieces.groupBy("length", "part").agg(F.count("*").alias("found")))
    counts = {r["length"]: r["n"] for r in found.groupBy("length").agg(F.sum("found").alias("n")).collect()}  # at most size rows
    plan = Plan(counts, size)
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranks = found.select("length", "part", F.coalesce(F.sum("found").over(earlier), F.lit(0)).alias("_base"))
    placed = (pieces.join(ranks, ["length", "part"])
              .withColumn("_place", plan.column(F.col("length"), F.col("_base") + F.col("nth"))))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "_place.sequence_id", "_place.offset",
                         *["ids"] * keep_ids)


def op12_best_two_fit(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """All pieces of all documents in sequences of at most 2,048 ids."""
    scratch = Scratch(spark, "op12")
    return scratch.finish(pack(table(spark, sf_dir, "documents"), scratch, tokenizer=tokenizer, keep_ids=False))
