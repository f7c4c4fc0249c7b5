"""Repeated byte strings by common-prefix interval trees over the suffixes at content-chosen anchors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewatch.llm.common import KeyFilter, Scratch, as_binary, bytes_and_offsets, lean, table
from tapewatch.llm.near_dedup import span_hashes
from tapewatch.llm.tokens import split_batch
from tapewatch.session import parallelism

LENGTH = 400
GRAM = 64
#: contexts of one anchor that one task takes; more are compared window by window
GROUP_LIMIT = 100_000
_PLACE_BITS = 24
_STEP = 1 << 19


def anchors(raw: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors: for each window of ``length`` bytes inside a text, the first gram of
    least hash. Equal windows have their anchor in the same place, so every repeat meets in one."""
    width = length - gram + 1
    ends = np.repeat(offsets[1:], np.diff(offsets))
    places, hashes = [], []
    for start in range(0, max(0, len(raw) - length + 1), _STEP):
        part = raw[start:start + _STEP + length - 1]
        n = len(part) - gram + 1
        at = np.arange(n)
        h = span_hashes(part, at, at + gram)
        key = (h >> np.uint64(_PLACE_BITS) << np.uint64(_PLACE_BITS)) | at.astype(np.uint64)
        padded = np.full((n + width - 1) // width * width, np.iinfo(np.uint64).max, np.uint64)
        padded[:n] = key
        blocks = padded.reshape(-1, width)
        forward = np.minimum.accumulate(blocks, axis=1).ravel()
        backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        windows = n - width + 1
        least = np.minimum(backward[:windows], forward[width - 1:width - 1 + windows])
        inside = np.arange(start, start + windows) + length <= ends[start:start + windows]
        mark = np.zeros(n, bool)
        mark[(least[inside] & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)] = True
        found = np.flatnonzero(mark)
        places.append(found + start)
        hashes.append(h[found])
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    place, first = np.unique(np.concatenate(places), return_index=True)
    return place, np.concatenate(hashes)[first]


def _context(place: int, lo: int, hi: int, length: int, gram: int) -> tuple[int, int]:
    """The bytes that a window over the anchor can hold, within the text from ``lo`` to ``hi``."""
    return max(lo, place - (length - gram)), min(hi, place + length)


def _anchor_lists(length: int, gram: int):
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in split_batch(batch.column(2), 1 << 19):
                raw, at = bytes_and_offsets(batch.column(2).slice(lo, hi - lo))
                place, h = anchors(raw, at, length, gram)
                data, bounds = raw.tobytes(), at.tolist()
                doc = np.searchsorted(at, place, side="right") - 1
                context = np.empty(len(place), np.uint64)
                for i, (p, d) in enumerate(zip(place.tolist(), doc.tolist())):
                    a, b = _context(p, bounds[d], bounds[d + 1], length, gram)
                    context[i] = xxhash.xxh3_64_intdigest(data[a:b], p - a)
                lists = pa.array(np.searchsorted(doc, np.arange(hi - lo + 1)).astype(np.int32))
                column = lambda v: pa.ListArray.from_arrays(lists, pa.array(v))
                yield pa.record_batch([batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo),
                                       column(h.view(np.int64)), column(context.view(np.int64)), column(place - at[doc])],
                                      ["doc_id", "text_key", "h", "context", "place"])
    return run


# ---- interval trees -------------------------------------------------------------------------

def _matrix(strings: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(s) for s in strings], np.int64)
    return np.frombuffer(b"".join(s.ljust(width, b"\0") for s in strings), np.uint8).reshape(-1, width), lengths


def _common(matrix: np.ndarray, lengths: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of rows ``a`` and ``b``."""
    out = np.empty(len(a), np.int64)
    for lo in range(0, len(a), 8192):
        i, j = a[lo:lo + 8192], b[lo:lo + 8192]
        differ = matrix[i] != matrix[j]
        first = np.where(differ.any(axis=1), differ.argmax(axis=1), matrix.shape[1])
        out[lo:lo + 8192] = np.minimum(first, np.minimum(lengths[i], lengths[j]))
    return out


def intervals(lcp: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """The common-prefix intervals ``(length, first, last)`` of a sorted list of suffixes, by one scan with a stack.

    ``lcp[i]`` is the common prefix of suffixes i - 1 and i; intervals shorter than ``least`` are left out.
    """
    stack: list[tuple[int, int]] = []
    for i, value in enumerate([*lcp[1:], 0], 1):
        begin = i - 1
        while stack and stack[-1][0] > value:
            length, begin = stack.pop()
            if length >= least:
                yield length, begin, i - 1
        if value and (not stack or stack[-1][0] < value):
            stack.append((value, begin))


def extents(groups: np.ndarray, left: list[bytes], right: list[bytes], length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """How far the repeats over each anchor reach: bytes before it and bytes from its start, 0 and 0 if none.

    ``left`` holds the bytes before each anchor last first, ``right`` those from it on; ``groups`` are the
    anchors' hashes, and equal ones are next to each other. Sorted by ``right`` the suffixes form a tree of
    common-prefix intervals. In each interval its members, in the order of ``left``, are diverse to the left of
    what neighbours share there; a repeat of ``length`` bytes or more is what an interval shares to the right and
    neighbours share to the left, and all its occurrences are the members concerned.
    """
    m = len(groups)
    by_right = sorted(range(m), key=lambda i: (groups[i], right[i]))
    by_left = sorted(range(m), key=lambda i: (groups[i], left[i]))
    rank = np.empty(m, np.int64)
    rank[by_left] = np.arange(m)
    r_matrix, r_lengths = _matrix(right, length)
    l_matrix, l_lengths = _matrix(left, length - gram)
    order = np.array(by_right, np.int64)
    lcp = np.zeros(m, np.int64)
    lcp[1:] = np.where(groups[order[1:]] == groups[order[:-1]], _common(r_matrix, r_lengths, order[:-1], order[1:]), 0)
    one, two, depth = [], [], []
    for shared, first, last in intervals(lcp.tolist(), gram):
        members = order[first:last + 1]
        if len(members) == 2:
            members = members.tolist()
        else:
            members = members[np.argsort(rank[members])].tolist()
        one += members[:-1]
        two += members[1:]
        depth += [shared] * (len(members) - 1)
    a, b, reach = np.array(one, np.int64), np.array(two, np.int64), np.array(depth, np.int64)
    before = _common(l_matrix, l_lengths, a, b)
    found = before + reach >= length
    out_left, out_right = np.zeros(m, np.int64), np.zeros(m, np.int64)
    for side in (a[found], b[found]):
        np.maximum.at(out_left, side, before[found])
        np.maximum.at(out_right, side, reach[found])
    return out_left, out_right


def _tree_task(length: int, gram: int):
    """Extents of whole groups; rows come sorted by group, and a group is not cut between calls."""
    def solve(h: list[int], context: list[int], left: list[bytes], right: list[bytes]) -> pa.RecordBatch:
        before, after = extents(np.array(h), [x[::-1] for x in left], right, length, gram)
        keep = np.flatnonzero(after)
        return pa.record_batch([pa.array(np.array(h, np.int64)[keep]), pa.array(np.array(context, np.int64)[keep]),
                                pa.array(before[keep]), pa.array(after[keep])], ["h", "context", "before", "after"])

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[], [], [], []]
        for batch in batches:
            for i in range(4):
                held[i] += batch.column(i).to_pylist()
            if len(held[0]) >= 20_000:
                cut = len(held[0])
                while cut and held[0][cut - 1] == held[0][-1]:
                    cut -= 1
                if cut:
                    yield solve(*[x[:cut] for x in held])
                    held = [x[cut:] for x in held]
        if held[0]:
            yield solve(*held)
    return run


def _window_rows(length: int, gram: int):
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for h, context, left, right in zip(*[batch.column(i).to_pylist() for i in range(4)]):
                data, p = left + right, len(left)
                offs = [o for o in range(min(p, length - gram) + 1) if p - o + length <= len(data)]
                marks = [xxhash.xxh3_128_digest(data[p - o:p - o + length]) for o in offs]
                yield pa.record_batch([pa.array([h] * len(offs), pa.int64()), pa.array([context] * len(offs), pa.int64()),
                                       pa.array(offs, pa.int64()), as_binary(marks)], ["h", "context", "before", "mark"])
    return run


def _large_group_extents(contexts: DataFrame, length: int, gram: int) -> DataFrame:
    """The same extents for anchors of very many contexts: every window by its 128-bit hash, in rows that
    spread over all tasks; as many per context as a window has offsets."""
    windows = contexts.select("h", "context", "left", "right").mapInArrow(
        _window_rows(length, gram), "h long, context long, before long, mark binary")
    twice = windows.groupBy("h", "before", "mark").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    return (windows.hint("merge").join(twice, ["h", "before", "mark"]).groupBy("h", "context")
            .agg(F.max("before").alias("before"), (F.lit(length) - F.min("before")).alias("after")))


# ---- jobs -----------------------------------------------------------------------------------

def repeated_extents(docs: DataFrame, found: DataFrame, scratch: Scratch, length: int, gram: int, limit: int) -> DataFrame:
    """``h, context, before, after``: the reach of repeats over the anchors of each kind of context.

    Contexts are first counted: anchors whose whole context occurs twice need no tree. Only the
    others of an anchor that occurs more than once, one text of each kind, are fetched from a second scan.
    """
    flat = found.select(F.explode(F.arrays_zip("h", "context")).alias("a")).select("a.h", "a.context")
    kinds = flat.groupBy("h", "context").agg(F.count(F.lit(1)).alias("n"))
    per = scratch.put(kinds.groupBy("h").agg(F.count(F.lit(1)).alias("kinds"), F.sum("n").alias("total"), F.min("n").alias("least"))
                      .filter(F.col("total") > 1))
    kinds = scratch.put(kinds.hint("merge").join(per, "h").select("h", "context", "n", "kinds", "least"))
    mixed = (F.col("kinds") > 1) & (F.col("least") == 1)
    wanted = scratch.put(kinds.filter(mixed).select("h", "context", "kinds"))
    may = KeyFilter(wanted, "context")

    @lean
    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in split_batch(batch.column(0), 1 << 19):
                raw, at = bytes_and_offsets(batch.column(0).slice(lo, hi - lo))
                place, h = anchors(raw, at, length, gram)
                data, bounds = raw.tobytes(), at.tolist()
                doc = np.searchsorted(at, place, side="right") - 1
                rows = [(p, *_context(p, bounds[d], bounds[d + 1], length, gram)) for p, d in zip(place.tolist(), doc.tolist())]
                context = np.array([xxhash.xxh3_64_intdigest(data[a:b], p - a) for p, a, b in rows], np.uint64)
                if not len(context):
                    continue
                hit = may.test(context)
                _, once = np.unique(context[hit], return_index=True)
                take = np.flatnonzero(hit)[once]
                yield pa.record_batch([pa.array(h[take].view(np.int64)), pa.array(context[take].view(np.int64)),
                                       as_binary([data[rows[i][1]:rows[i][0]] for i in take]),
                                       as_binary([data[rows[i][0]:rows[i][2]] for i in take])], ["h", "context", "left", "right"])

    texts = docs.select("text").mapInArrow(fetch, "h long, context long, left binary, right binary")
    texts = scratch.put(wanted.hint("merge").join(texts, ["h", "context"]).dropDuplicates(["h", "context"])
                        .select("h", "context", "left", "right", "kinds"), codec="lz4")
    schema = "h long, context long, before long, after long"
    small = (texts.filter(F.col("kinds") <= limit).select("h", "context", "left", "right")
             .repartition(4 * parallelism(docs.sparkSession), "h").sortWithinPartitions("h").mapInArrow(_tree_task(length, gram), schema))
    large = _large_group_extents(texts.filter(F.col("kinds") > limit), length, gram)
    # a context that occurs twice is repeated as far as it goes
    same = kinds.filter(F.col("n") > 1).select("h", "context", F.lit(length - gram).cast("long").alias("before"),
                                               F.lit(length).cast("long").alias("after"))
    both = small.unionByName(large).unionByName(same)
    return scratch.put(both.groupBy("h", "context").agg(F.max("before").alias("before"), F.max("after").alias("after")))


def repeated_spans(docs: DataFrame, scratch: Scratch, length: int = LENGTH, gram: int = GRAM, limit: int = GROUP_LIMIT) -> DataFrame:
    """``doc_id, text_key, spans``: the byte ranges of each text that are covered by strings of ``length`` bytes that
    also start elsewhere; ranges may overlap and are not in order."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    found = scratch.put(rows.mapInArrow(_anchor_lists(length, gram),
                                        "doc_id long, text_key long, h array<long>, context array<long>, place array<long>"))
    reach = repeated_extents(docs, found, scratch, length, gram, limit)
    may = KeyFilter(reach, "context")

    @lean
    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = np.diff(batch.column(2).offsets.to_numpy())
            context = batch.column(3).flatten()
            hit = np.flatnonzero(may.test(context.to_numpy().view(np.uint64))) if len(context) else np.zeros(0, np.int64)
            take = pa.array(np.repeat(np.arange(batch.num_rows), counts)[hit])
            hit = pa.array(hit)
            yield pa.record_batch([batch.column(0).take(take), batch.column(1).take(take), batch.column(2).flatten().take(hit),
                                   context.take(hit), batch.column(4).flatten().take(hit)],
                                  ["doc_id", "text_key", "h", "context", "place"])

    each = found.mapInArrow(suspects, "doc_id long, text_key long, h long, context long, place long")
    spans = each.hint("merge").join(reach, ["h", "context"]).select(
        "doc_id", "text_key", F.struct(F.greatest(F.lit(0), F.col("place") - F.col("before")).alias("lo"),
                                       (F.col("place") + F.col("after")).alias("hi")).alias("span"))
    return scratch.put(spans.groupBy("doc_id", "text_key").agg(F.collect_set("span").alias("spans")))


def merged(spans: list[tuple[int, int]], end: int) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for lo, hi in sorted((a, min(b, end)) for a, b in spans):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def drop_repeats(docs: DataFrame, scratch: Scratch, length: int = LENGTH, gram: int = GRAM, limit: int = GROUP_LIMIT) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, removed`` (maximal byte ranges) and ``kept`` (the other bytes).

    A byte goes when it lies in a string of ``length`` bytes that also starts elsewhere in any text, the same
    one included; overlaps count, no string crosses texts, and all is judged on the input. Null text
    counts as empty; texts shorter than ``length`` lose nothing. Null and repeated ids and rows are documents of
    their own; other columns are ignored; an empty table gives no rows.
    """
    spans = repeated_spans(docs, scratch, length, gram, limit)
    may = KeyFilter(spans, "text_key")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    affected = may.may_hold(F.col("text_key"))
    none = F.lit(None).cast("array<struct<lo:bigint,hi:bigint>>")
    whole = rows.filter(~affected).select("doc_id", "text", none.alias("spans"))  # not shuffled
    named = spans.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "spans")
    part = (rows.filter(affected).hint("merge")
            .join(named, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")), "left")
            .select("doc_id", "text", "spans"))

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, kept = [], [], []
            for text, found in zip(batch.column(1), batch.column(2)):
                data = text.as_py().encode() if text.is_valid else b""
                cuts = merged([(s["lo"], s["hi"]) for s in found.as_py()], len(data)) if found.is_valid else []
                at, rest = 0, []
                for lo, hi in cuts:
                    rest.append(data[at:lo])
                    at = hi
                sizes.append(len(data))
                removed.append([{"lo": lo, "hi": hi} for lo, hi in cuts])
                kept.append(b"".join([*rest, data[at:]]))
            kind = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))
            yield pa.record_batch([batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, kind), as_binary(kept)],
                                  ["doc_id", "n_bytes", "removed", "kept"])
    return whole.unionByName(part).mapInArrow(
        run, "doc_id long, n_bytes long, removed array<struct<lo:bigint,hi:bigint>>, kept binary")


def op8_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes, removed bytes and runs, and the digest of the bytes left, of every document."""
    scratch = Scratch(spark, "op8")
    out = drop_repeats(table(spark, sf_dir, "documents"), scratch)
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda total, s: total + s["hi"] - s["lo"])
    return scratch.finish(out.select("doc_id", "n_bytes", gone.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"),
                                     F.sha2("kept", 256).alias("kept_sha256")))
