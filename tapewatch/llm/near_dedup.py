"""Near-dedup on word shingles: fast similarity sketches, banding, exact verification, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapewatch.llm.common import KeyFilter, SPACE_BYTES, WORD, Scratch, anonymous, as_binary, bytes_and_offsets, lean, mix64, table
from tapewatch.llm.components import components
from tapewatch.llm.tokens import split_batch

COORDINATES, ROWS = 128, 4
BANDS = COORDINATES // ROWS
#: A pair at the similarity of 0.8 agrees in fewer than this many of the 128 coordinates once in some 10^8.
LEAST_AGREEMENT = 72
#: text that is cut into shingles at a time; hashing its words takes some sixty times that
PIECE_BYTES = 1 << 19
#: sets of one cell of a bucket's grid
CELL = 256
_BASE = 0x9E3779B97F4A7C15 | 1
_SEED = np.uint64(0xD6E8FEB86659FD93)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2^64."""
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps, dtype=np.uint64)
    return _powers


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans that depend on the bytes alone."""
    up, down = _power_tables(len(raw) + 1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:len(raw)], dtype=np.uint64)))
    return mix64((sums[ends] - sums[starts]) * down[starts] ^ ((ends - starts).astype(np.uint64) << np.uint64(40)))


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of each text in turn, A-Z lower-cased, and n + 1 offsets; null has no words."""
    raw, offsets = bytes_and_offsets(column)
    upper = (raw >= 65) & (raw <= 90)
    raw = np.where(upper, raw + np.uint8(32), raw)
    solid = ~SPACE_BYTES[raw]
    before = np.concatenate(([False], solid[:-1]))
    after = np.concatenate((solid[1:], [False]))
    first = np.zeros(len(raw) + 1, bool)
    first[offsets] = True
    starts = np.flatnonzero(solid & (~before | first[:-1]))
    ends = np.flatnonzero(solid & (~after | first[1:])) + 1
    return span_hashes(raw, starts, ends), np.searchsorted(starts, offsets)


def shingle_sets(column: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text as sorted 64-bit hashes, and n + 1 offsets.

    A text of fewer than ``words`` words has its whole sequence as one shingle.
    """
    hashes, at = word_hashes(column)
    n, counts = len(column), np.diff(at)
    if len(hashes) >= words:
        joined = hashes[:len(hashes) - words + 1].copy()
        for i in range(1, words):
            joined = mix64(joined * np.uint64(0xC2B2AE3D27D4EB4F) + hashes[i:len(hashes) - words + 1 + i])
    else:
        joined = np.zeros(0, np.uint64)
    doc = np.repeat(np.arange(n), counts)
    place = np.arange(len(hashes)) - at[:-1][doc]
    whole = np.flatnonzero(place + words <= counts[doc])
    values, owners = joined[whole], doc[whole]
    short = np.flatnonzero((counts > 0) & (counts < words))
    if len(short):
        single = np.empty(len(short), np.uint64)
        for j, d in enumerate(short):
            value = np.array([counts[d]], np.uint64)
            for h in hashes[at[d]:at[d + 1]]:
                value = mix64(value ^ h) + _SEED
            single[j] = value[0]
        values, owners = np.concatenate((values, single)), np.concatenate((owners, short))
    order = np.lexsort((values, owners))
    values, owners = values[order], owners[order]
    fresh = np.ones(len(values), bool)
    fresh[1:] = (values[1:] != values[:-1]) | (owners[1:] != owners[:-1])
    values, owners = values[fresh], owners[fresh]
    return values, np.searchsorted(owners, np.arange(n + 1))


def piece_sets(column: pa.Array, words: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``shingle_sets`` of row ranges ``lo, hi`` of a text column, in memory bounded by a piece or the longest text."""
    for lo, hi in split_batch(column, PIECE_BYTES):
        yield lo, hi, *shingle_sets(column.slice(lo, hi - lo), words)


def set_keys(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each whole set; zero for empty sets."""
    filled = np.flatnonzero(np.diff(offsets))
    one, two = np.zeros(len(offsets) - 1, np.uint64), np.zeros(len(offsets) - 1, np.uint64)
    if len(filled):
        mixed = mix64(values ^ _SEED)
        one[filled] = np.bitwise_xor.reduceat(mixed, offsets[filled])
        two[filled] = np.add.reduceat(mix64(mixed + _SEED), offsets[filled])
    return one.view(np.int64), two.view(np.int64)


def sketches(values: np.ndarray, offsets: np.ndarray, t: int = COORDINATES) -> np.ndarray:
    """Fast similarity sketches: ``t`` 16-bit coordinates per set; two sets agree in one with their similarity.

    In round i < t every element throws one value, i + a hash in [0, 1), into a hashed bin and each bin keeps
    the least; a set stops after the round that fills its last bin. Round t + b throws all elements into
    bin b, so every bin is filled. Large sets need one or two rounds instead of t hashes per element.
    """
    counts = np.diff(offsets)
    n = len(counts)
    least = np.full(n * t, np.iinfo(np.uint64).max, np.uint64)
    empty_value = np.iinfo(np.uint64).max
    doc = np.repeat(np.arange(n), counts)
    active = counts > 0
    x, owner = values, doc
    for i in range(2 * t):
        if i:
            open_sets = (least.reshape(n, t) == empty_value).any(axis=1) & active
            if not open_sets.any():
                break
            keep = open_sets[owner]
            x, owner = x[keep], owner[keep]
        h = mix64(x + np.uint64((i + 1) * int(_SEED) & 0xFFFFFFFFFFFFFFFF))
        bins = (h % np.uint64(t)).astype(np.int64) if i < t else np.full(len(x), i - t)
        np.minimum.at(least, owner * t + bins, (np.uint64(i) << np.uint64(48)) | (h >> np.uint64(16)))
    return (mix64(least).reshape(n, t) & np.uint64(0xFFFF)).astype(np.uint16)


def band_keys(sketch: np.ndarray) -> np.ndarray:
    """One key per band; the band's number is in the top bits."""
    rows = sketch.reshape(len(sketch), BANDS, ROWS).astype(np.uint64)
    key = np.zeros(rows.shape[:2], np.uint64)
    for r in range(ROWS):
        key = (key << np.uint64(16)) | rows[:, :, r]
    key = mix64(key) >> np.uint64(8)
    return (key | (np.arange(BANDS, dtype=np.uint64) << np.uint64(56))).view(np.int64)


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")


def _sketch_docs(docs: DataFrame, words: int) -> DataFrame:
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, values, at in piece_sets(batch.column(2), words):
                one, two = set_keys(values, at)
                found = sketches(values, at)
                yield pa.record_batch([batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(np.diff(at)),
                                       pa.array(one), pa.array(two), as_binary([s.tobytes() for s in found])],
                                      ["doc_id", "text_key", "n_shingles", "k1", "k2", "sketch"])
    return _rows(docs).mapInArrow(run, "doc_id long, text_key long, n_shingles long, k1 long, k2 long, sketch binary")


def _buckets(classes: DataFrame) -> DataFrame:
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = np.stack([np.frombuffer(s.as_buffer(), np.uint16) for s in batch.column(1)])
                yield pa.record_batch([pa.array(band_keys(found).ravel()), pa.array(np.repeat(batch.column(0).to_numpy(), BANDS))],
                                      ["key", "cls"])
    return classes.select("cls", "sketch").mapInArrow(run, "key long, cls long")


def _agreement(a: Column, b: Column) -> Column:
    @F.pandas_udf("int")
    def agree(x, y):
        import pandas as pd
        p = np.frombuffer(b"".join(x), np.uint16).reshape(-1, COORDINATES)
        q = np.frombuffer(b"".join(y), np.uint16).reshape(-1, COORDINATES)
        return pd.Series((p == q).sum(axis=1).astype(np.int32))
    return agree(a, b)


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


def _sets_of(docs: DataFrame, wanted: DataFrame, words: int, scratch: Scratch) -> DataFrame:
    """``cls, sketch, shingles`` of the wanted classes (``k1, k2, cls, sketch``), from a second scan of the texts.

    Only texts whose set key may be wanted leave the scan; one text of each set is enough.
    """
    may = KeyFilter(wanted, "k1")

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, values, at in piece_sets(batch.column(0), words):
                one, two = set_keys(values, at)
                _, rows = np.unique(np.stack((one, two)), axis=1, return_index=True)
                rows = rows[may.test(one[rows].view(np.uint64)) & (np.diff(at)[rows] > 0)]
                if len(rows):
                    yield pa.record_batch([pa.array(one[rows]), pa.array(two[rows]),
                                           as_binary([values[at[i]:at[i + 1]].tobytes() for i in rows])], ["k1", "k2", "shingles"])

    found = docs.select("text").mapInArrow(run, "k1 long, k2 long, shingles binary")
    joined = wanted.join(found, ["k1", "k2"]).select("cls", "sketch", "shingles")
    return scratch.put(joined.dropDuplicates(["cls"]), codec="lz4")


def _star_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links of bucket members to the bucket's leader; pairs are as many as members, whatever a bucket's size."""
    pairs = members.filter(F.col("cls") != F.col("leader")).select("cls", "leader").distinct()
    near = (pairs.join(sets.select("cls", F.col("sketch").alias("s1")), "cls")
            .join(sets.select(F.col("cls").alias("leader"), F.col("sketch").alias("s2")), "leader")
            .filter(_agreement(F.col("s1"), F.col("s2")) >= LEAST_AGREEMENT).select("cls", "leader"))
    both = (near.join(sets.select("cls", F.col("shingles").alias("a")), "cls")
            .join(sets.select(F.col("cls").alias("leader"), F.col("shingles").alias("b")), "leader"))

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = [_linked(np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64), percent)
                   for a, b in zip(batch.column(2), batch.column(3))]
            if any(hit):
                kept = batch.filter(pa.array(hit))
                yield pa.record_batch([kept.column(0), kept.column(1)], ["u", "v"])
    return both.select("cls", "leader", "a", "b").mapInArrow(run, "u long, v long")


def _cell_links(percent: int):
    """Links between sets of different components in one cell: outside ones against all, on full sets.

    A pair is looked at only in the first band it shares, and of two components one link is enough.
    """
    def run(key, frame):
        import pandas as pd
        band = (int(key[0]) >> 56) & 0xFF
        cls, comp = frame["cls"].to_numpy(), frame["comp"].to_numpy()
        outside, member = frame["outside"].to_numpy(), frame["member"].to_numpy()
        sketch = np.frombuffer(b"".join(frame["sketch"]), np.uint16).reshape(-1, COORDINATES)
        sets = [np.frombuffer(s, np.uint64) for s in frame["shingles"]]
        columns = np.flatnonzero(member)
        pool = np.concatenate([sets[c] for c in columns]) if len(columns) else np.zeros(0, np.uint64)
        bounds = np.concatenate(([0], np.cumsum([len(sets[c]) for c in columns]))).astype(np.int64)
        sizes = np.diff(bounds)
        found: dict[tuple[int, int], tuple[int, int]] = {}
        for i in np.flatnonzero(outside):
            same = sketch[columns] == sketch[i]
            near = (same.sum(axis=1) >= LEAST_AGREEMENT) & (comp[columns] != comp[i])
            shared = same.reshape(-1, BANDS, ROWS).all(axis=2)
            near &= shared.any(axis=1) & (shared.argmax(axis=1) == band)
            near &= (100 * np.minimum(sizes, len(sets[i])) >= percent * np.maximum(sizes, len(sets[i])))
            if not near.any():
                continue
            take = np.flatnonzero(near)
            spread = np.repeat(near, sizes)
            at = np.searchsorted(sets[i], pool[spread])
            hit = sets[i][np.minimum(at, len(sets[i]) - 1)] == pool[spread]
            common = np.add.reduceat(hit, np.concatenate(([0], np.cumsum(sizes[take])))[:-1])
            linked = 100 * common >= percent * (sizes[take] + len(sets[i]) - common)
            for j in columns[take[linked]]:
                found.setdefault((min(comp[i], comp[j]), max(comp[i], comp[j])), (cls[i], cls[j]))
        return pd.DataFrame(list(found.values()), columns=["u", "v"], dtype=np.int64)
    return run


def _rest_links(members: DataFrame, labels: DataFrame, sets: DataFrame, percent: int, scratch: Scratch,
                cell: int = CELL) -> DataFrame:
    """Links that the stars left open: between components that still share a bucket.

    In such a bucket one component has the most members; each pair between components has a side
    outside it. A grid deals the members in blocks and the outside ones in blocks to cells of
    bounded size, so a bucket of any size is many tasks.
    """
    placed = (members.join(labels.select(F.col("u").alias("cls"), F.col("v").alias("least")), "cls", "left")
              .select("key", "cls", F.coalesce("least", "cls").alias("comp")))
    per = placed.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n"))
    open_ones = (per.groupBy("key").agg(F.count(F.lit(1)).alias("comps"), F.sum("n").alias("size"),
                                        F.max(F.struct("n", "comp")).alias("top"))
                 .filter(F.col("comps") > 1)
                 .select("key", "size", F.col("top.comp").alias("main"), (F.col("size") - F.col("top.n")).alias("others")))
    rows = placed.join(scratch.put(open_ones), "key")  # settled, so that a large bucket is split in the join
    grid = lambda n: F.ceil(F.col(n) / F.lit(cell)).cast("int")
    block = F.pmod(F.xxhash64("cls"), grid("size")).cast("int")
    other_block = F.pmod(F.xxhash64("cls", F.lit(1)), grid("others")).cast("int")
    is_out = F.col("comp") != F.col("main")
    everywhere = lambda n: F.sequence(F.lit(0), grid(n) - 1)
    as_member = F.transform(everywhere("others"), lambda o: F.struct(block.alias("i"), o.alias("j"), F.lit(True).alias("member"),
                                                                     F.lit(False).alias("outside")))
    as_other = F.transform(everywhere("size"), lambda b: F.struct(b.alias("i"), other_block.alias("j"), F.lit(False).alias("member"),
                                                                  F.lit(True).alias("outside")))
    dealt = rows.select("key", "cls", "comp", F.explode(F.when(is_out, F.concat(as_member, as_other)).otherwise(as_member)).alias("c"))
    dealt = dealt.select("key", "c.i", "c.j", "cls", "comp", "c.member", "c.outside")
    return (scratch.put(dealt).join(sets, "cls").groupBy("key", "i", "j")
            .applyInPandas(_cell_links(percent), "u long, v long"))


def _grouped(docs: DataFrame, words: int, percent: int, cell: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """``(sketched, named)``: a row per document, and per class (``k1, k2, n_shingles``) its least id (null if none is known),
    its first row by id (null last) and text key, and its component ``comp``."""
    sketched = scratch.put(_sketch_docs(docs, words))
    first = F.struct(F.col("doc_id").isNull().alias("unknown"), F.col("doc_id"), F.col("text_key"))
    classes = scratch.put(sketched.filter(F.col("n_shingles") > 0).groupBy("k1", "k2", "n_shingles")
                          .agg(F.first("sketch").alias("sketch"), F.min("doc_id").alias("least_id"), F.min(first).alias("first"))
                          .withColumn("cls", F.monotonically_increasing_id()))
    buckets = scratch.put(_buckets(classes))
    shared = (buckets.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("cls")).alias("x"),
                                         F.min("cls").alias("leader")).filter(F.col("n") > 1))
    shared = shared.groupBy("n", "x", "leader").agg(F.min("key").alias("key"))  # buckets of the same members count once
    members = scratch.put(buckets.join(shared.select("key", "leader"), "key"))
    scratch.drop(buckets)
    wanted = classes.join(members.select("cls").distinct(), "cls").select("k1", "k2", "cls", "sketch")
    sets = _sets_of(docs, scratch.put(wanted), words, scratch)
    stars = scratch.put(_star_links(members, sets, percent))
    labels = components(stars, scratch)
    rest = scratch.put(_rest_links(members, labels, sets, percent, scratch, cell))
    labels = components(labels.unionByName(rest), scratch)
    return sketched, classes.join(labels.select(F.col("u").alias("cls"), F.col("v").alias("least")), "cls", "left").select(
        "k1", "k2", "n_shingles", "least_id", "first", F.coalesce("least", "cls").alias("comp"))


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, cell: int = CELL) -> DataFrame:
    """One row per document: ``doc_id, text_key, n_shingles, component_id, kept``.

    Documents whose sets of ``words``-word shingles have a similarity of ``percent`` / 100 or more are linked;
    ``component_id`` is the least id reachable over links. Null, empty and blank texts have no shingles and
    are linked with nothing. Of rows with the component's id only one is ``kept``; rows with null ids
    count last. Columns other than ``doc_id`` and ``text`` are ignored; an empty table gives no rows.
    ``kept`` goes by id; where ids are null or repeated, ``drop_near_duplicates`` tells components apart.

    Equal sets are one class. Classes that agree in one of 32 bands of 4 sketch coordinates meet in a
    bucket: a pair at the limit of 0.8 misses all bands once in 10^7. Stars around one
    leader per bucket find most links with as many pairs as members; what they leave open is compared
    on full sets within the buckets that still hold several components.
    """
    scratch = Scratch(docs.sparkSession, "near")
    sketched, named = _grouped(docs, words, percent, cell, scratch)
    ids = named.groupBy("comp").agg(F.min("least_id").alias("component_id"))
    by_set = scratch.put(named.join(ids, "comp").select("k1", "k2", "n_shingles", "component_id"))
    out = sketched.select("doc_id", "text_key", "n_shingles", "k1", "k2").join(by_set, ["k1", "k2", "n_shingles"], "left")
    return scratch.finish(_kept(out))


def _kept(out: DataFrame) -> DataFrame:
    own = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    out = out.select("doc_id", "text_key", "n_shingles", own.alias("component_id"))
    turn = F.row_number().over(Window.partitionBy("doc_id", "component_id").orderBy("n_shingles", "text_key"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")) & (turn == 1))


def drop_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each group of near duplicates, that of the least id; all columns as they are.

    A group is told by its links, not by ids: a group without a known id keeps one row too, and unlike texts
    under one id or under none are groups of their own. Rows without words are linked with nothing and all stay.
    """
    scratch = Scratch(docs.sparkSession, "near")
    _, named = _grouped(docs, words, percent, CELL, scratch)
    stay = scratch.put(named.groupBy("comp").agg(F.min("first").alias("first"))
                       .select(F.col("first.doc_id").alias("_id"), F.col("first.text_key").alias("_key")))
    scratch.keep_only(stay)
    inner, back = anonymous(docs, "doc_id", "text")
    has_words = F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    rows = inner.filter(has_words).withColumn("_text_key", F.xxhash64("text"))
    found = rows.hint("merge").join(stay, F.col("doc_id").cast("long").eqNullSafe(F.col("_id"))
                                    & (F.col("_text_key") == F.col("_key")), "left_semi")
    # rows of one id and one text are in one group
    found = found.dropDuplicates(["doc_id", "_text_key"]).drop("_text_key")
    return back(found.unionByName(inner.filter(~has_words)))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=2).drop("text_key")
