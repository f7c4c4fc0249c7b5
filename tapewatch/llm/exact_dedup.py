"""Exact dedup by an exchange of Golomb-coded fingerprints."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapewatch.llm.common import KeyFilter, SPACE_BYTES, Scratch, bytes_and_offsets, lean, table

#: documents of one sender's list
BLOCK_DOCS = 1 << 16
#: fingerprints of one owner, about
OWNER_KEYS = 1 << 21


def golomb_encode(values: np.ndarray, universe: int) -> bytes:
    """Sorted distinct values below ``universe`` as Golomb-Rice codes of their gaps.

    Quotients are unary, remainders take ``k`` bits; the two streams lie one after the other so that
    both can be read without a loop.
    """
    n = len(values)
    if n == 0:
        return b""
    gaps = np.diff(values.astype(np.uint64), prepend=np.uint64(0))
    k = max(0, int(np.log2(max(1.0, 0.6931 * universe / n))))
    quotients = (gaps >> np.uint64(k)).astype(np.int64)
    unary = np.zeros(int(quotients.sum()) + n, np.uint8)
    unary[np.cumsum(quotients + 1) - 1] = 1
    shifts = np.arange(k - 1, -1, -1, dtype=np.uint64)
    rests = ((gaps[:, None] >> shifts) & np.uint64(1)).astype(np.uint8)
    head = np.array([n, k, len(unary)], "<i8").tobytes()
    return head + np.packbits(unary).tobytes() + np.packbits(rests).tobytes()


def golomb_decode(code: bytes) -> np.ndarray:
    if not code:
        return np.zeros(0, np.uint64)
    n, k, unary_bits = (int(x) for x in np.frombuffer(code, "<i8", 3))
    unary_bytes = (unary_bits + 7) // 8
    unary = np.unpackbits(np.frombuffer(code, np.uint8, unary_bytes, 24), count=unary_bits)
    quotients = np.diff(np.flatnonzero(unary), prepend=-1) - 1
    rests = np.unpackbits(np.frombuffer(code, np.uint8, offset=24 + unary_bytes), count=n * k).reshape(n, k)
    gaps = quotients.astype(np.uint64) << np.uint64(k)
    for j in range(k):
        gaps += rests[:, j].astype(np.uint64) << np.uint64(k - 1 - j)
    return np.cumsum(gaps)


def _normalised(column: pa.Array) -> tuple[bytes, np.ndarray, np.ndarray]:
    """All texts without white space in one buffer, the offsets in it, and the code points of the originals."""
    raw, offsets = bytes_and_offsets(column)
    solid = ~SPACE_BYTES[raw]
    starts = np.concatenate(([0], np.cumsum(solid)))[offsets]
    points = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))[offsets]
    return raw[solid].tobytes(), starts, np.diff(points)


def _digests(column: pa.Array) -> tuple[list[bytes], np.ndarray, list[bytes]]:
    data, at, lengths = _normalised(column)
    texts = [data[at[i]:at[i + 1]] for i in range(len(at) - 1)]
    return [hashlib.sha256(t).digest() for t in texts], lengths, texts


_LISTS = ("block long, owner int, codes binary, copies array<int>, doc_ids array<long>, "
          "lengths array<long>, digests array<binary>")


def _sender(bits: int, owner_bits: int):
    """One pass over a partition: per owner, the coded list of its distinct fingerprints in order."""
    def emit(block: int, digests: list[bytes], lengths: list[int], ids: list[int | None]) -> pa.RecordBatch:
        prints = np.array([int.from_bytes(d[:8], "big") for d in digests], np.uint64) >> np.uint64(64 - bits)
        order = np.argsort(prints, kind="stable")
        ordered = prints[order]
        owners = (ordered >> np.uint64(bits - owner_bits)).astype(np.int64)
        rows: dict[str, list] = {name: [] for name in ("block", "owner", "codes", "copies", "ids", "lengths", "digests")}
        for owner in np.unique(owners):
            lo, hi = np.searchsorted(owners, [owner, owner + 1])
            distinct, copies = np.unique(ordered[lo:hi], return_counts=True)
            within = distinct - (np.uint64(owner) << np.uint64(bits - owner_bits))
            mine = order[lo:hi]
            rows["block"].append(block)
            rows["owner"].append(int(owner))
            rows["codes"].append(golomb_encode(within, 1 << (bits - owner_bits)))
            rows["copies"].append(copies.astype(np.int32))
            rows["ids"].append([ids[i] for i in mine])
            rows["lengths"].append([lengths[i] for i in mine])
            rows["digests"].append([digests[i] for i in mine])
        return pa.record_batch([
            pa.array(rows["block"], pa.int64()), pa.array(rows["owner"], pa.int32()), pa.array(rows["codes"], pa.binary()),
            pa.array(rows["copies"], pa.list_(pa.int32())), pa.array(rows["ids"], pa.list_(pa.int64())),
            pa.array(rows["lengths"], pa.list_(pa.int64())), pa.array(rows["digests"], pa.list_(pa.binary()))],
            ["block", "owner", "codes", "copies", "doc_ids", "lengths", "digests"])

    @lean
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        digests, lengths, ids, count = [], [], [], 0
        for batch in batches:
            found, points, _ = _digests(batch.column(1))
            digests += found
            lengths += points.tolist()
            ids += batch.column(0).to_pylist()
            if len(ids) >= BLOCK_DOCS:
                yield emit(first + count, digests, lengths, ids)
                digests, lengths, ids, count = [], [], [], count + 1
        if ids:
            yield emit(first + count, digests, lengths, ids)

    return send


def _find_repeats(key, frame):
    """An owner's reply: for each list it got, a bit per fingerprint that another list holds too."""
    import pandas as pd
    lists = [golomb_decode(code) for code in frame["codes"]]
    values, counts = np.unique(np.concatenate(lists), return_counts=True)
    twice = values[counts > 1]
    replies = [np.packbits(np.isin(x, twice, assume_unique=True)).tobytes() for x in lists]
    return pd.DataFrame({"block": frame["block"], "owner": frame["owner"], "reply": replies})


def _suspect_keys(batch_iter: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batch_iter:
        keys: list[np.ndarray] = []
        for copies, digests, reply in zip(batch.column(0), batch.column(1), batch.column(2)):
            copies = copies.values.to_numpy()
            repeated = np.unpackbits(np.frombuffer(reply.as_py(), np.uint8), count=len(copies)).astype(bool) | (copies > 1)
            at = np.concatenate(([0], np.cumsum(copies)))[:-1][repeated]
            keys.append(np.array([int.from_bytes(digests.values[int(i)].as_py()[:8], "big") for i in at], np.uint64))
        if keys:
            yield pa.record_batch([pa.array(np.concatenate(keys).view(np.int64))], ["key"])


def exact_groups(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """``(lists, groups)``: the senders' lists with every document's id, length and digest, and one row per
    text that occurs more than once, checked byte by byte: ``text_sha256, keep_id, group_size``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    n = rows.count()
    # false suspects stay below one in 256: they cost a shuffled text each and never a result
    bits = min(63, max(24, n.bit_length() + 8))
    owner_bits = max(4, (n // OWNER_KEYS).bit_length())
    lists = scratch.put(rows.mapInArrow(_sender(bits, owner_bits), _LISTS))
    replies = (lists.select("block", "owner", "codes").groupBy("owner")
               .applyInPandas(_find_repeats, "block long, owner int, reply binary"))
    suspects = scratch.put(lists.join(replies, ["block", "owner"]).select("copies", "digests", "reply")
                           .mapInArrow(_suspect_keys, "key long"))
    may_repeat = KeyFilter(suspects, "key")

    @lean
    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, lengths, texts = _digests(batch.column(1))
            keys = np.array([int.from_bytes(d[:8], "big") for d in digests], np.uint64)
            take = np.flatnonzero(may_repeat.test(keys))
            if len(take):
                yield pa.record_batch([
                    pa.array([texts[i] for i in take], pa.binary()),
                    pa.array([digests[i].hex() for i in take], pa.string()),
                    pa.array(lengths[take]), batch.column(0).take(pa.array(take))],
                    ["normal", "text_sha256", "length", "doc_id"])

    texts = rows.mapInArrow(fetch, "normal binary, text_sha256 string, length long, doc_id long")
    # the text itself is the key, so equal rows are equal byte by byte; copies meet in the map-side aggregate
    best = F.max(F.struct("length", F.col("doc_id").isNotNull().alias("known"), (-F.col("doc_id")).alias("back")))
    groups = (texts.groupBy("normal", "text_sha256").agg(best.alias("best"), F.count(F.lit(1)).alias("group_size"))
              .filter(F.col("group_size") > 1)
              .select("text_sha256", (-F.col("best.back")).alias("keep_id"), "group_size"))
    return lists, scratch.put(groups)


def exact_dedup(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256, length``.

    Texts are equal when the same without white space (space, tab to carriage return); null counts as
    empty, so null, empty and blank texts are one group. Of a group the row with the most code points
    stays, then the smallest id; null ids come last. Of rows repeated whole only one is ``kept``.
    Columns other than ``doc_id`` and ``text`` are ignored; an empty table gives no rows.

    Each scan partition sends every owner (a range of the fingerprints) the sorted, Golomb-coded list
    of its distinct fingerprints, gets a bit map of those that others hold as well, and only texts
    with such a fingerprint are shuffled, keyed by their bytes.
    """
    scratch = Scratch(docs.sparkSession, "exact")
    lists, groups = exact_groups(docs, scratch)
    each = (lists.select(F.explode(F.arrays_zip("doc_ids", "lengths", "digests")).alias("d"))
            .select(F.col("d.doc_ids").alias("doc_id"), F.col("d.lengths").alias("length"),
                    F.lower(F.hex("d.digests")).alias("text_sha256")))
    # before the join, so that this is dealt by id and text, not by the text of a large group
    turn = F.row_number().over(Window.partitionBy("doc_id", "text_sha256").orderBy(F.desc("length")))
    joined = each.withColumn("turn", turn).join(groups, "text_sha256", "left")
    size = F.coalesce(F.col("group_size"), F.lit(1).cast("long"))
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return scratch.finish(joined.select(
        "doc_id", keep.alias("keep_id"), size.alias("group_size"),
        (F.col("doc_id").eqNullSafe(keep) & (F.col("turn") == 1)).alias("kept"), "text_sha256", "length"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents")).drop("length")


OP3_SQL = r"""
WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS len,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS t FROM documents),
g AS (SELECT t, arg_min(doc_id, (-len, doc_id)) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM n JOIN g USING (t)
"""
