"""Line dedup: content-defined chunks of lines; chunks repeated anywhere stay in their first place only."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapewatch.llm.common import KeyFilter, Scratch, anonymous, as_binary, lean, table

#: lines of the rolling window, and one boundary in so many lines
WINDOW, SPREAD = 2, 4
_FACTOR, _MODULUS = 69069, 1 << 32


def chunk_bounds(lines: list[str], window: int = WINDOW, spread: int = SPREAD) -> list[tuple[int, int]]:
    """Line ranges that end where the rolling hash over the last ``window`` line hashes falls on a multiple of
    ``spread``: a boundary depends on the lines just before it, so inserted lines shift no other one."""
    hashes = [int.from_bytes(hashlib.md5(line.encode()).digest()[:4], "big") for line in lines]
    rolled, top, out, start = 0, pow(_FACTOR, window, _MODULUS), [], 0
    for i, h in enumerate(hashes):
        rolled = (rolled * _FACTOR + h) % _MODULUS
        if i >= window:
            rolled = (rolled - hashes[i - window] * top) % _MODULUS
        if (rolled >> 16) % spread == 0 or i + 1 == len(lines):
            out.append((start, i + 1))
            start = i + 1
    return out


def long_chunks(text: str | None) -> tuple[list[str], list[tuple[int, int, int, bytes]]]:
    """The lines of a text, and of its chunks of two or more lines the number, range and digest."""
    lines = text.split("\n") if text is not None else []
    found = []
    if len(lines) > 1:
        for number, (lo, hi) in enumerate(chunk_bounds(lines)):
            if hi - lo > 1:
                found.append((number, lo, hi, hashlib.md5("\n".join(lines[lo:hi]).encode()).digest()))
    return lines, found


def _rows(docs: DataFrame) -> DataFrame:
    """Ids, texts, and a hash of each text that tells rows of one id, or without one, apart."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, keys, numbers, digests = [], [], [], []
        for doc_id, text_key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            for number, _, _, digest in long_chunks(text.as_py())[1]:
                ids.append(doc_id)
                keys.append(text_key)
                numbers.append(number)
                digests.append(digest)
        yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(keys, pa.int64()), pa.array(numbers, pa.int64()), as_binary(digests),
                               pa.array([int.from_bytes(d[:8], "big", signed=True) for d in digests], pa.int64())],
                              ["doc_id", "text_key", "number", "digest", "key"])


def _place():
    """Order of occurrences: by id (null last), among texts of one id by their hash, then by place in the document."""
    return F.struct(F.col("doc_id").isNull().alias("unknown"), F.col("doc_id"), F.col("text_key"), F.col("number"))


def repeated_chunks(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``doc_id, text_key, chunks``: per document the (number, digest) of the chunks that also occur in an earlier place.

    Digests name the suspects; their texts alone are shuffled, and equal bytes make a group. Copies meet
    in the map-side aggregate, so a passage of any number of copies is a row per task.
    """
    rows = _rows(docs)
    found = scratch.put(rows.mapInArrow(_occurrences, "doc_id long, text_key long, number long, digest binary, key long"))
    twice = (found.groupBy("digest").agg(F.min(_place()).alias("first"), F.max(_place()).alias("last"), F.first("key").alias("key"))
             .filter(F.col("first") != F.col("last")).select("key"))
    may_repeat = KeyFilter(scratch.put(twice), "key")

    @lean
    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        for batch in batches:
            ids, keys, numbers, digests, texts = [], [], [], [], []
            for doc_id, text_key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                lines, chunks = long_chunks(text.as_py())
                for number, lo, hi, digest in chunks:
                    ids.append(doc_id)
                    keys.append(text_key)
                    numbers.append(number)
                    digests.append(digest)
                    texts.append((lines, lo, hi))
            if not ids:
                continue
            hit = np.flatnonzero(may_repeat.test(np.array([int.from_bytes(d[:8], "big") for d in digests], np.uint64)))
            yield pa.record_batch([pa.array([ids[i] for i in hit], pa.int64()), pa.array([keys[i] for i in hit], pa.int64()),
                                   pa.array([numbers[i] for i in hit], pa.int64()),
                                   as_binary([digests[i] for i in hit]),
                                   as_binary(["\n".join(texts[i][0][texts[i][1]:texts[i][2]]).encode() for i in hit])],
                                  ["doc_id", "text_key", "number", "digest", "bytes"])

    texts = rows.mapInArrow(fetch, "doc_id long, text_key long, number long, digest binary, bytes binary")
    groups = (texts.groupBy("bytes", "digest").agg(F.min(_place()).alias("first"), F.max(_place()).alias("last"))
              .filter(F.col("first") != F.col("last")).select("digest", F.col("first").alias("home")))
    # nothing above the join needs the rows of a digest together, so a passage of many copies is split
    later = found.hint("merge").join(scratch.put(groups), "digest").filter(_place() != F.col("home"))
    return scratch.put(later.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("number", "digest")).alias("chunks")))


def drop_repeated_lines(docs: DataFrame, scratch: Scratch, counts: bool = True) -> DataFrame:
    """``docs`` without the lines of chunks that occur in an earlier place, and with ``counts`` ``lines``, ``lines_removed``.

    Lines end at line feeds. A chunk counts when it has two or more lines; its first place, by id (null
    last) and then by position, stays. Different texts under one id, or without an id, are documents of
    their own, in the order of a hash; rows equal in id and text are one and are treated alike. Null text stays null with no lines; a text whose lines all go is empty. All rows and
    columns stay; with ``counts`` existing columns ``lines`` and ``lines_removed`` are replaced.
    """
    repeated = repeated_chunks(docs, scratch)
    scratch.keep_only(repeated)
    rows, back = anonymous(docs, "doc_id", "text")
    kept = rows.columns
    name = [F.col("doc_id").cast("long"), F.xxhash64("text")]
    may = KeyFilter(repeated.select(F.xxhash64("doc_id", "text_key").alias("key")), "key")
    affected = may.may_hold(F.xxhash64(*name))
    empty = F.lit(None).cast("array<struct<number:bigint,digest:binary>>")
    # rows that lose nothing are not shuffled
    whole = rows.filter(~affected).select("*", empty.alias("_chunks"))
    named = repeated.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), F.col("chunks").alias("_chunks"))
    part = (rows.filter(affected).hint("merge")
            .join(named, name[0].eqNullSafe(F.col("_id")) & (name[1] == F.col("_key")), "left").drop("_id", "_key"))
    at, last = kept.index("text"), len(kept)
    schema = T.StructType([*rows.schema.fields] + [T.StructField("lines", T.LongType()),
                                                            T.StructField("lines_removed", T.LongType())])

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, sizes, removed = [], [], []
            for text, gone in zip(batch.column(at), batch.column(last)):
                text = text.as_py()
                lost = 0
                if gone.is_valid and text is not None:
                    names = {(g["number"], g["digest"]) for g in gone.as_py()}
                    lines, chunks = long_chunks(text)
                    drop = [(lo, hi) for number, lo, hi, digest in chunks if (number, digest) in names]
                    lost = sum(hi - lo for lo, hi in drop)
                    sizes.append(len(lines))
                    for lo, hi in reversed(drop):
                        del lines[lo:hi]
                    text = "\n".join(lines) if lost else text
                else:
                    sizes.append(text.count("\n") + 1 if text is not None else 0)
                texts.append(text)
                removed.append(lost)
            columns = [pa.array(texts, pa.string()) if i == at else batch.column(i) for i in range(last)]
            yield pa.record_batch([*columns, pa.array(sizes, pa.int64()), pa.array(removed, pa.int64())],
                                  [*kept, "lines", "lines_removed"])
    out, added = whole.unionByName(part).mapInArrow(run, schema), ["lines", "lines_removed"]
    return back(out, added, added) if counts else back(out)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines, removed lines and the digest of the text that is left, of every document."""
    scratch = Scratch(spark, "op7")
    out = drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), scratch)
    return scratch.finish(out.select("doc_id", F.col("lines").alias("n_lines"), F.col("lines_removed").alias("n_removed"),
                                     F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256")))


OP7_SQL = r"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                  generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents WHERE text IS NOT NULL),
h AS (SELECT *, CAST('0x' || substr(md5(line), 1, 8) AS BIGINT) AS h FROM l),
r AS (SELECT *, (coalesce(lag(h) OVER w, 0) * 69069 + h) % 4294967296 AS roll,
             count(*) OVER (PARTITION BY doc_id) AS n FROM h WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
c AS (SELECT *, coalesce(sum(CASE WHEN (roll >> 16) % 4 = 0 THEN 1 ELSE 0 END)
                OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS no FROM r),
k AS (SELECT doc_id, no, string_agg(line, chr(10) ORDER BY i) AS body, count(*) AS len FROM c GROUP BY doc_id, no),
d AS (SELECT doc_id, no FROM (SELECT *, row_number() OVER (PARTITION BY body ORDER BY doc_id, no) AS place FROM k WHERE len > 1)
      WHERE place > 1),
o AS (SELECT c.doc_id, count(*) AS n_lines, count(d.no) AS n_removed,
             coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (d.no IS NULL), '') AS kept
      FROM c LEFT JOIN d ON c.doc_id = d.doc_id AND c.no = d.no GROUP BY c.doc_id)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents LEFT JOIN o USING (doc_id)
"""
