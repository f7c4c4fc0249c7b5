"""Phrase mining over word indexes: an FM-index per shard of text, phrases told and summed across shards.

Each shard keeps the Burrows-Wheeler transform of its words. The rows that begin with one phrase are an
interval of it; an interval at depth m lies inside that of its first m - 1 words, and its rows go
one step on into that of its last m - 1 words. So one sweep over the rows extends every phrase to both
sides at once. Phrases are extended only where both shorter ones are frequent in all shards together,
and go across shards as the pair of their numbers: each shard sends sorted, packed lists to the owners
of hash buckets, which sum them and answer with the intervals of the frequent ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapewatch.llm.common import Scratch, bytes_and_offsets, lean, mix64, table
from tapewatch.llm.files import Reader, create
from tapewatch.llm.tokens import split_batch
from tapewatch.session import parallelism

LONGEST, LEAST, SHARE, FIRST = 4, 30, 80, 2000
#: a shard is closed when it has so many words; it bounds the memory of a task and changes no count
SHARD_WORDS = 1 << 21
#: words of all texts for which there is a bucket of phrases, if that makes more than there are tasks
BUCKET_WORDS = 1 << 22
#: What ends a piece, and what separates words besides.
ENDS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
_KIND = np.zeros(256, np.uint8)
_KIND[list(BLANKS)], _KIND[list(ENDS)] = 1, 2


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """All words with ``A-Z`` in lower case, the row of each, and whether it begins a piece."""
    raw, offsets = bytes_and_offsets(texts)
    ends = offsets[1:] + np.arange(len(offsets) - 1)  # each text is closed by an end of its own
    data = np.full(len(raw) + len(ends), ENDS[6], np.uint8)
    inside = np.ones(len(data), bool)
    inside[ends] = False
    data[inside] = raw
    data[(data >= 65) & (data <= 90)] += 32
    kind = _KIND[data]
    solid = np.concatenate(([False], kind == 0, [False]))
    edges = np.flatnonzero(solid[1:] != solid[:-1])
    starts, stops = edges[::2], edges[1::2]
    closed = np.cumsum(kind == 2, dtype=np.int32)[starts]
    begins = np.diff(closed, prepend=-1) != 0
    at = np.concatenate(([0], np.cumsum(stops - starts))).astype(np.int32)
    words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(at.tobytes()), pa.py_buffer(data[kind == 0].tobytes()))
    return words, np.searchsorted(ends, starts), begins


def transform(symbols: np.ndarray, depth: int) -> np.ndarray:
    """The Burrows-Wheeler transform of a circular sequence whose rows are sorted by their first ``depth`` symbols."""
    rank, width = symbols.astype(np.int64), 1
    order = np.argsort(rank)
    while width < depth:
        pair = rank * (int(rank.max()) + 1) + np.roll(rank, -width)
        order = np.argsort(pair)
        ordered = pair[order]
        rank[order] = np.cumsum(np.diff(ordered, prepend=ordered[:1]) != 0)
        width *= 2
    return symbols[order - 1]


class Index:
    """Intervals of the phrases of one shard, from its transform."""

    def __init__(self, last: np.ndarray):
        #: row -> row of the same text one symbol later
        self.after = np.argsort(last, kind="stable")
        first = last[self.after]
        self.starts = [np.flatnonzero(np.diff(first, prepend=-1))]
        self.label = first.astype(np.int64)

    def extend(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``(interval, count, number of the phrase but its last word, but its first)`` of the phrases one word longer
        of which both have a number; ``numbers`` has one per interval, -1 for none. Later calls start from these."""
        beyond = self.label[self.after]
        new = np.diff(self.label, prepend=-1) != 0
        new |= np.diff(beyond, prepend=-1) != 0
        starts = np.flatnonzero(new)
        counts = np.diff(starts, append=len(new))
        head, tail = numbers[self.label[starts]], numbers[beyond[starts]]
        kept = np.flatnonzero((head >= 0) & (tail >= 0))
        self.label = np.cumsum(new) - 1
        return kept, counts[kept], head[kept], tail[kept]

    def deepen(self) -> None:
        """Intervals one word deeper, all of them."""
        beyond = self.label[self.after]
        self.label = np.cumsum((np.diff(self.label, prepend=-1) != 0) | (np.diff(beyond, prepend=-1) != 0)) - 1

    @property
    def intervals(self) -> int:
        return int(self.label.max(initial=0)) + 1


def _index(docs: DataFrame, root: str) -> DataFrame:
    """``shard, local, lang, word, found``: the words of each shard with their counts, and a row with its file and sizes."""
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, turn = TaskContext.get().partitionId(), 0
        words: list[pa.Array] = []
        langs: list[pa.Array] = []
        begins: list[np.ndarray] = []
        held = 0

        def close() -> pa.RecordBatch:
            texts = pa.chunked_array(words, pa.string()).dictionary_encode().combine_chunks()
            of = pa.chunked_array(langs, pa.string()).dictionary_encode().combine_chunks()
            texts, of = (x.chunk(0) if isinstance(x, pa.ChunkedArray) else x for x in (texts, of))
            kinds = len(of.dictionary)
            both = texts.indices.to_numpy().astype(np.int64) * kinds + of.indices.to_numpy()
            known, local, found = np.unique(both, return_inverse=True, return_counts=True)
            first = np.concatenate(begins)
            symbols = np.zeros(len(local) + int(first.sum()), np.int32)
            symbols[np.arange(len(local)) + np.cumsum(first)] = local + 1
            path, stream = create(root, ".bwt")
            packed = pa.compress(transform(symbols, LONGEST).tobytes(), "zstd", asbytes=True)
            with stream:
                stream.write(packed)
            n = len(known)
            shard = part << 11 | turn
            return pa.record_batch(
                [pa.array(np.full(n + 1, shard, np.int64)), pa.array(np.arange(n + 1)),
                 pa.concat_arrays([pa.nulls(1, pa.string()), of.dictionary.take(pa.array(known % kinds))]),
                 pa.concat_arrays([pa.nulls(1, pa.string()), texts.dictionary.take(pa.array(known // kinds))]),
                 pa.array(np.concatenate(([len(symbols)], found))), pa.array([path] + [None] * n, pa.string()),
                 pa.array([len(packed)] + [None] * n, pa.int64())],
                ["shard", "local", "lang", "word", "found", "path", "packed"])

        for batch in batches:
            for lo, hi in split_batch(batch.column(1)):
                flat, row, new = split_words(batch.column(1).slice(lo, hi - lo))
                if len(flat):
                    words.append(flat)
                    langs.append(batch.column(0).slice(lo, hi - lo).take(pa.array(row)))
                    begins.append(new)
                    held += len(flat)
                if held >= SHARD_WORDS:
                    yield close()
                    words, langs, begins, held, turn = [], [], [], 0, turn + 1
        if held:
            yield close()

    return (docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
            .mapInArrow(run, "shard long, local long, lang string, word string, found long, path string, packed long"))


def _frequent_words(found: DataFrame, least: int) -> DataFrame:
    """Rows of words found ``least`` times in all shards, with the total ``f`` and the number ``gid`` of the word: the
    smallest ``code`` that a shard has for it. A word has a row per shard."""
    same = Window.partitionBy("lang", "word")
    return (found.withColumn("f", F.sum("found").over(same)).withColumn("gid", F.min("code").over(same))
            .filter(F.col("f") >= least))


def pack_numbers(*columns: np.ndarray) -> bytes:
    """Equally long columns of whole numbers as their byte planes, most of which are zero, compressed."""
    planes = [np.ascontiguousarray(c.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes() for c in columns]
    return pa.compress(b"".join(planes), "zstd", asbytes=True)


def unpack_numbers(data, count: int, columns: int) -> list[np.ndarray]:
    raw = np.frombuffer(pa.decompress(data, 8 * count * columns, "zstd"), np.uint8).reshape(columns, 8, count)
    return [np.ascontiguousarray(c.T).view("<i8").ravel() for c in raw]


def _offers(files: DataFrame, tasks: int, held: DataFrame, depth: int, buckets: int) -> DataFrame:
    """``bucket, shard, n, data``: the phrases of ``depth`` words of each shard, by the numbers of both shorter ones. A
    phrase goes to the bucket of its hash; ``data`` has the numbers, in order, the counts and the intervals."""
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader()
        for batch in batches:
            for shard, path, size, packed, known in zip(*[batch.column(i).to_pylist() for i in range(4)], batch.column(4)):
                index = Index(np.frombuffer(pa.decompress(reader.read(path, 0, packed), 4 * size, "zstd"), np.int32))
                for _ in range(depth - 2):
                    index.deepen()
                numbers = np.full(index.intervals, -1, np.int64)
                for count, answer in zip(known.values.field("n").to_pylist(), known.values.field("answer")):
                    interval, gid = unpack_numbers(answer.as_buffer(), count, 2)
                    numbers[interval] = gid
                interval, count, head, tail = index.extend(numbers)
                del index, numbers
                bucket = (mix64(mix64(head.view(np.uint64)) ^ tail.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
                order = np.lexsort((tail, head, bucket))
                ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
                for i in np.flatnonzero(np.diff(ends)).tolist():
                    at = order[ends[i]:ends[i + 1]]
                    data = pack_numbers(np.diff(head[at], prepend=0), tail[at], count[at], interval[at])
                    yield pa.record_batch([pa.array([i]), pa.array([shard]), pa.array([len(at)]), pa.array([data], pa.binary())],
                                          ["bucket", "shard", "n", "data"])
        reader.close()

    return (files.join(held, "shard").select("shard", "path", "size", "packed", "held").repartition(tasks, "shard")
            .mapInArrow(run, "bucket long, shard long, n long, data binary"))


def _merge_offers(least: int):
    """Sums the phrases of a bucket over all shards; rows come sorted by bucket. Gives a row per frequent phrase, and per
    shard an answer: the intervals there that hold one, with its number."""
    def solve(bucket: int, offers: list[tuple]) -> Iterator[pa.RecordBatch]:
        parts = [unpack_numbers(data, n, 4) for _, n, data in offers]
        head = np.concatenate([np.cumsum(p[0]) for p in parts])
        tail, count, interval = (np.concatenate([p[i] for p in parts]) for i in (1, 2, 3))
        shard = np.repeat(np.array([o[0] for o in offers], np.int64), [o[1] for o in offers])
        order = np.lexsort((tail, head))
        new = (np.diff(head[order], prepend=-1) != 0) | (np.diff(tail[order], prepend=-1) != 0)
        starts = np.flatnonzero(new)
        f = np.add.reduceat(count[order], starts)
        often = f >= least
        if not often.any():
            return
        gid = np.where(often, (bucket << 32) + np.cumsum(often) - 1, -1)
        first = order[starts[often]]
        nothing = lambda n, kind=pa.int64(): pa.nulls(n, kind)
        m = len(first)
        yield pa.record_batch([pa.array(gid[often]), pa.array(head[first]), pa.array(tail[first]), pa.array(f[often]),
                               nothing(m), nothing(m), nothing(m, pa.binary())], names)
        of = np.repeat(gid, np.diff(starts, append=len(order)))
        held = order[of >= 0]
        of = of[of >= 0]
        by_shard = np.lexsort((interval[held], shard[held]))
        held, of = held[by_shard], of[by_shard]
        cuts = np.flatnonzero(np.diff(shard[held], prepend=-1))
        for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(held)]):
            yield pa.record_batch([*[nothing(1)] * 4, pa.array(shard[held[a:a + 1]]), pa.array([b - a]),
                                   pa.array([pack_numbers(interval[held[a:b]], of[a:b])], pa.binary())], names)

    names = ["gid", "head", "tail", "f", "shard", "n", "answer"]

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, offers = -1, []
        for batch in batches:
            for bucket, shard, n, data in zip(*[batch.column(i).to_pylist() for i in range(4)]):
                if bucket != current and offers:
                    yield from solve(current, offers)
                    offers = []
                current = bucket
                offers.append((shard, n, data))
        if offers:
            yield from solve(current, offers)
    return run


def _answers_of_words(known: DataFrame) -> DataFrame:
    """``shard, n, answer`` of frequent words, in the form that longer phrases have them."""
    def run(key, frame):
        import pandas as pd
        return pd.DataFrame({"shard": [key[0]], "n": [len(frame)], "answer": [pack_numbers(
            frame["code"].to_numpy(np.int64) & 0xFFFFFFFF, frame["gid"].to_numpy(np.int64))]})

    return (known.select("code", "gid", F.shiftright("code", 32).alias("shard")).groupBy("shard")
            .applyInPandas(run, "shard long, n long, answer binary"))  # a shard is bounded


def phrases(docs: DataFrame, scratch: Scratch, longest: int = LONGEST, least: int = LEAST) -> tuple[list[DataFrame], DataFrame]:
    """Tables of the phrases of 1, 2, ... ``longest`` (at most 4) words found ``least`` times per language, and ``lang, n``.

    Each table has ``gid, head, tail, lang, words, f, heads, tails``: its number, those of the phrase without its last
    and without its first word, and the counts of its first and last 1, 2, ... words. Null ``lang`` is ``und``; null text is
    empty; other columns are ignored; repeated rows count each time.
    """
    if not 1 <= longest <= LONGEST:
        raise ValueError(f"an index is sorted by {LONGEST} words")
    indexed = scratch.put(_index(docs, f"{scratch.root}/index"))
    files = scratch.put(indexed.filter(F.col("path").isNotNull()).select("shard", "path", F.col("found").alias("size"), "packed"))
    shards, words = files.agg(F.count(F.lit(1)), F.sum("size")).first()
    shards = max(1, shards)
    vocabulary = indexed.filter(F.col("path").isNull())
    sizes = scratch.put(vocabulary.groupBy("lang").agg(F.sum("found").alias("n")))
    coded = vocabulary.select("lang", "word", F.expr("shiftleft(shard, 32) | local").alias("code"), "found")
    known = scratch.put(_frequent_words(coded, least))
    tables = [scratch.put(known.filter("code = gid").select(
        "gid", F.lit(None).cast("long").alias("head"), F.lit(None).cast("long").alias("tail"), "lang",
        F.array("word").alias("words"), "f", F.array("f").alias("heads"), F.array("f").alias("tails")))]
    answers = scratch.put(_answers_of_words(known))
    scratch.drop(indexed, known)
    tasks = 4 * parallelism(docs.sparkSession)
    # a bucket is one task's work at a time, so there are more of them the more words there are
    buckets = max(tasks, (words or 0) // BUCKET_WORDS)
    for depth in range(2, longest + 1):
        held = answers.groupBy("shard").agg(F.collect_list(F.struct("n", "answer")).alias("held"))  # a row per shard, of its own phrases
        offers = _offers(files, min(shards, tasks), held, depth, buckets)
        merged = scratch.put(offers.repartition(max(1, buckets // 4), "bucket").sortWithinPartitions("bucket").mapInArrow(
            _merge_offers(least), "gid long, head long, tail long, f long, shard long, n long, answer binary"))
        answers = merged.filter(F.col("answer").isNotNull()).select("shard", "n", "answer")
        shorter = tables[-1]
        heads = shorter.select(F.col("gid").alias("head"), "lang", "words", "heads")
        tails = shorter.select(F.col("gid").alias("tail"), F.element_at("words", -1).alias("_last"), "tails")
        tables.append(scratch.put(
            merged.filter(F.col("gid").isNotNull()).select("gid", "f", "head", "tail").join(heads, "head").join(tails, "tail")
            .select("gid", "head", "tail", "lang", F.concat("words", F.array("_last")).alias("words"), "f",
                    F.concat("heads", F.array("f")).alias("heads"), F.concat("tails", F.array("f")).alias("tails"))))
    return tables, sizes


def _swallowed(tables: list[DataFrame]) -> DataFrame:
    """``depth, gid, most``: the largest count of a longer phrase around each phrase that has one."""
    inside = []
    for longer in range(2, len(tables)):
        around = tables[longer].select("f", F.explode(F.array("head", "tail")).alias("gid"))
        for depth in range(longer, 1, -1):
            # the table at depth words; summed up first, as one phrase may be inside very many
            around = around.groupBy("gid").agg(F.max("f").alias("f"))
            inside.append(around.select(F.lit(depth).alias("depth"), "gid", "f"))
            if depth > 2:
                around = (around.join(tables[depth - 1].select("gid", "head", "tail"), "gid")
                          .select("f", F.explode(F.array("head", "tail")).alias("gid")))
    if not inside:
        return tables[0].select(F.lit(0).alias("depth"), "gid", F.col("f").alias("most")).limit(0)
    out = inside[0]
    for more in inside[1:]:
        out = out.unionByName(more)
    return out.groupBy("depth", "gid").agg(F.max("f").alias("most"))


def collocations(docs: DataFrame, scratch: Scratch, longest: int = LONGEST, least: int = LEAST, share: int = SHARE,
                 first: int = FIRST) -> DataFrame:
    """The ``first`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    Phrases of 2 to ``longest`` words, found ``a >= least`` times inside the pieces between punctuation and line ends. Cut after
    its first k words a phrase has the score ``floor(2000000 * a / (l + r))`` with the counts of both parts; the cut with the
    lowest score counts, of equal ones the first. A phrase inside a longer one that is found at least ``share`` percent as often is left
    out. Order: score, then ``a``, falling, then the bytes of the phrase. Null ``lang`` is ``und``; null and empty texts have no words;
    other columns are ignored; no rows give none.
    """
    tables, sizes = phrases(docs, scratch, longest, least)
    schema = "lang string, rank long, phrase string, a long, l long, r long, n long, score long"
    if longest < 2:
        return docs.sparkSession.createDataFrame([], schema)
    found = None
    for depth in range(2, longest + 1):
        cuts = [F.struct(F.expr(f"(CAST(2000000 AS decimal(38,0)) * f) div (heads[{k - 1}] + tails[{depth - k - 1}])").alias("score"),
                         F.lit(k).alias("k"), F.col("heads")[k - 1].alias("l"), F.col("tails")[depth - k - 1].alias("r"))
                for k in range(1, depth)]
        best = F.least(*cuts) if len(cuts) > 1 else cuts[0]
        each = tables[depth - 1].select(F.lit(depth).alias("depth"), "gid", "lang", F.concat_ws(" ", "words").alias("phrase"),
                                        F.col("f").alias("a"), best.alias("_cut"))
        found = each if found is None else found.unionByName(each)
    wide = "decimal(38,0)"
    kept = (found.join(_swallowed(tables), ["depth", "gid"], "left")
            .filter(F.col("most").isNull() | (F.col("most").cast(wide) * 100 < F.col("a").cast(wide) * share))
            .select("lang", "phrase", "a", "_cut.l", "_cut.r", F.col("_cut.score").cast("long").alias("score")))
    order = [F.desc("score"), F.desc("a"), "phrase"]
    # the best of each share of a language first, so that no task sorts a whole language
    shares = max(8, parallelism(docs.sparkSession))
    kept = (kept.withColumn("_share", F.pmod(F.xxhash64("phrase"), F.lit(shares)))
            .withColumn("_turn", F.row_number().over(Window.partitionBy("lang", "_share").orderBy(*order)))
            .filter(F.col("_turn") <= first))
    ranked = (kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
              .filter(F.col("rank") <= first))
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 phrases of each language of all documents."""
    scratch = Scratch(spark, "op13")
    return scratch.finish(collocations(table(spark, sf_dir, "documents"), scratch))


OP13_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
texts AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, m, w[i:i + m - 1] AS g
  FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM texts, (SELECT unnest([1, 2, 3, 4]) AS m)) x),
f AS (SELECT lang, m, g, count(*) AS f FROM grams GROUP BY ALL),
sizes AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang),
phrases AS (SELECT * FROM f WHERE m > 1 AND f >= 30),
cuts AS (
  SELECT p.lang, p.m, p.g, p.f AS a, k, l.f AS l, r.f AS r, ((2000000::HUGEINT * p.f) // (l.f + r.f))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM phrases) p
  JOIN f l ON l.lang = p.lang AND l.g = p.g[1:k]
  JOIN f r ON r.lang = p.lang AND r.g = p.g[k + 1:p.m]),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
inner_parts AS (
  SELECT lang, g[i:i + s - 1] AS g, f
  FROM (SELECT *, unnest(range(1, m - s + 2)) AS i FROM (SELECT *, unnest(range(2, m)) AS s FROM phrases) y) z),
around AS (SELECT lang, g, max(f) AS most FROM inner_parts GROUP BY lang, g),
kept AS (
  SELECT b.*, array_to_string(b.g, ' ') AS phrase FROM best b LEFT JOIN around o ON o.lang = b.lang AND o.g = b.g
  WHERE o.most IS NULL OR 100::HUGEINT * o.most < 80::HUGEINT * b.a)
SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept k JOIN sizes s ON s.lang = k.lang
QUALIFY rank <= 2000
"""
