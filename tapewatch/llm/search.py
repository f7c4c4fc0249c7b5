"""Exact top-k search by BM25: groups of queries on the inverted index of each shard, merged with global statistics.

Queries may be whole texts of hundreds of terms, which bounds of terms or blocks keep from few documents. So what is
spared is the cost of a pair: terms that many queries and documents have are a product of matrices.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapewatch.llm.common import Scratch, as_binary, lean, table
from tapewatch.llm.near_dedup import word_hashes
from tapewatch.llm.packing import curve_keys
from tapewatch.llm.tokens import split_batch

K1, B = 1.2, 0.75
#: a shard ends at so many documents or words
SHARD_DOCS, SHARD_WORDS = 16_384, 4_000_000
#: documents and queries that are searched at once
STRETCH, GROUP = 4096, 1024
#: A posting added by itself costs as much as so many cells of a product of matrices; rows of a stretch's matrix, at most,
#: and of those that are multiplied at once
WORTH, COMMON, ROWS = 384, 2048, 1024
#: lengths of posting lists in a stretch, and queries whose postings are added in turn
LENGTHS, FEW = np.unique([0] + [x << i for i in range(16) for x in (1, 3)]), 128
ADD = np.add
#: postings that are added at once, and terms of the queries of a group, about
POSTINGS, GROUP_TERMS = 1 << 14, 1 << 19
#: Shards are searched in rounds: a 512th, a 64th, an 8th, the rest. A round starts from the k-th scores found so far,
#: so few documents of later shards are scored exactly, and fewer still are merged.
ROUNDS = ((0, 1), (1, 8), (8, 64), (64, 512))
#: terms of the queries that are sent to all shards at once
QUERY_TERMS = 2_000_000

_INDEX = ("shard long, words long, doc_ids array<long>, lengths binary, terms binary, counts binary, docs binary, tf binary")


def _places(words: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Each text's place on a curve through its words; -1 without words."""
    filled = np.flatnonzero(np.diff(offsets))
    keys = np.full(len(offsets) - 1, -1, np.int64)
    if len(filled):
        keys[filled] = curve_keys((words & np.uint64(0xFFFF)).astype(np.int64), np.append(offsets[filled], offsets[-1]))
    return keys


def _index_row(shard: int, hashes: list[np.ndarray], lengths: np.ndarray, ids: list[int | None]) -> pa.RecordBatch:
    """One shard: postings by term and document, documents in the order of a curve through their words.

    Neighbours on the curve have words in common, so few rows of a stretch's matrix are as good as empty.
    """
    words = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    order = np.argsort(_places(words, np.concatenate(([0], np.cumsum(lengths)))), kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    found = pa.array(words).dictionary_encode()
    terms = found.dictionary.to_numpy()
    rank = np.argsort(terms)
    terms, which = terms[rank], np.argsort(rank)[found.indices.to_numpy()]
    pair = which * len(lengths) + place[np.repeat(np.arange(len(lengths)), lengths)] if len(words) else which
    postings, tf = np.unique(pair, return_counts=True)
    term_of, doc_of = np.divmod(postings, max(1, len(lengths)))
    counts = np.bincount(term_of, minlength=len(terms))
    return pa.record_batch([
        pa.array([shard]), pa.array([len(words)]), pa.array([[ids[i] for i in order]], pa.list_(pa.int64())),
        as_binary([lengths[order].astype("<u4").tobytes()]), as_binary([terms.astype("<u8").tobytes()]),
        as_binary([counts.astype("<u4").tobytes()]), as_binary([doc_of.astype("<u2").tobytes()]),
        as_binary([np.minimum(tf, 0xFFFFFFFF).astype("<u4").tobytes()])],
        ["shard", "words", "doc_ids", "lengths", "terms", "counts", "docs", "tf"])


def build_index(docs: DataFrame) -> DataFrame:
    """One row per shard; a shard is a stretch of a scan partition of bounded size."""
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 32
        hashes, lengths, ids, words = [], [], [], 0
        for batch in batches:
            for lo, hi in ((a, min(a + 4096, hi)) for lo, hi in split_batch(batch.column(1), 2 << 20) for a in range(lo, hi, 4096)):
                h, at = word_hashes(batch.column(1).slice(lo, hi - lo))
                if ids and (words + len(h) > SHARD_WORDS or len(ids) + hi - lo > SHARD_DOCS):
                    yield _index_row(shard, hashes, np.concatenate(lengths), ids)
                    shard += 1
                    hashes, lengths, ids, words = [], [], [], 0
                hashes.append(h)
                lengths.append(np.diff(at))
                ids += batch.column(0).slice(lo, hi - lo).to_pylist()
                words += len(h)
        if ids:
            yield _index_row(shard, hashes, np.concatenate(lengths), ids)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _INDEX)


class Shard:
    """The index of one shard in memory, by term and by document."""

    def __init__(self, row: dict, average: float):
        number = lambda name, kind: np.frombuffer(row[name], kind)
        self.ids = row["doc_ids"]
        self.tie = np.array([np.iinfo(np.int64).max if d is None else d for d in self.ids], np.int64)
        self.terms = number("terms", "<u8")
        self.counts = number("counts", "<u4").astype(np.int64)
        self.begins = np.cumsum(self.counts) - self.counts
        self.docs = number("docs", "<u2")
        self.tf, self.damping = number("tf", "<u4"), K1 * (1 - B + B * number("lengths", "<u4").astype(np.float64) / average)
        self.term = np.repeat(np.arange(len(self.terms), dtype=np.int32), self.counts)
        by_doc = np.argsort(self.docs, kind="stable")  # terms of a document stay in their order
        self.doc_terms, self.doc_tf = self.term[by_doc], self.tf[by_doc]
        self.doc_sizes = np.bincount(self.docs, minlength=len(self.ids))
        self.doc_ends = np.cumsum(self.doc_sizes)

    def _impact(self, postings: np.ndarray) -> np.ndarray:
        return _impact(self.tf[postings], self.damping[self.docs[postings]])

    def _score(self, at: np.ndarray, weights: np.ndarray, *_) -> np.ndarray:
        """Scores of all documents for one query; terms add up in one order."""
        take = _ranges(self.begins[at], self.counts[at])
        return np.bincount(self.docs[take], weights=self._impact(take) * np.repeat(weights, self.counts[at]), minlength=len(self.ids))

    def _score_pairs(self, offsets: np.ndarray, at: np.ndarray, weights: np.ndarray, query: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Scores of single documents for single queries, ascending, as exact as ``_score``: terms add up in the same order."""
        out, weight = np.zeros(len(doc)), np.zeros(len(self.terms))
        for lo, hi in _cuts(query):
            own = slice(offsets[query[lo]], offsets[query[lo] + 1])
            ends = self.doc_ends[doc[lo:hi]]
            begins = ends - self.doc_sizes[doc[lo:hi]]
            if (ends - begins).sum() > self.counts[at[own]].sum():  # as many equal texts have
                out[lo:hi] = self._score(at[own], weights[own])[doc[lo:hi]]
                continue
            weight[at[own]] = weights[own]
            for i, (begin, end) in enumerate(zip(begins.tolist(), ends.tolist()), lo):
                value = weight.take(self.doc_terms[begin:end])
                value *= _impact(self.doc_tf[begin:end], self.damping[doc[i]])
                out[i] = np.cumsum(value)[-1]
            weight[at[own]] = 0
        return out

    def best(self, offsets: np.ndarray, at: np.ndarray, weights: np.ndarray, k: int, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query, document and score of the best ``k`` documents of each query among those that score its ``least`` or
        more; the smaller id wins a tie. ``at`` holds the terms of each query, ascending.

        A stretch of neighbours on the curve is searched for a group of queries at once. Queries whose terms' maxima in the
        stretch do not reach the k-th score so far leave the group. Terms that many of its queries and documents
        have are multiplied as matrices of 32-bit floats, the postings of the others are added one by one. What reaches
        the k-th score within the rounding of those floats is scored anew, exactly.
        """
        least = least.copy()
        query = np.repeat(np.arange(len(least), dtype=np.int32), np.diff(offsets))
        groups = [(a, min(a + GROUP, hi)) for lo, hi in _cuts(offsets[1:] // GROUP_TERMS) for a in range(lo, hi, GROUP)]
        kept = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)) for _ in groups]
        cuts = np.linspace(0, len(self.ids), -(-len(self.ids) // STRETCH) + 1).astype(np.int64).tolist()
        for low, high in zip(cuts, cuts[1:]):
            stretch = _Stretch(self, low, high, at)
            for g, (lo, hi) in enumerate(groups):
                part = slice(offsets[lo], offsets[hi])
                q, doc = stretch.reach(query[part] - lo, at[part], weights[part], k, least[lo:hi])
                if not len(q):
                    continue
                score = self._score_pairs(offsets[lo:hi + 1], at, weights, q, doc)
                q, doc, score = (np.concatenate(x) for x in zip(kept[g], (q, doc, score)))
                order = np.lexsort((self.tie[doc], -score, q))
                q, doc, score = q[order], doc[order], score[order]
                first = np.searchsorted(q, np.arange(hi - lo))
                place = np.arange(len(q)) - first[q]
                full = place == k - 1
                least[lo + q[full]] = np.maximum(least[lo + q[full]], score[full])
                stays = (place < k) & (score >= least[lo + q])
                kept[g] = q[stays], doc[stays], score[stays]
            del stretch  # before the next one is made
        q, doc, score = (np.concatenate([x[i] + lo if not i else x[i] for x, (lo, _) in zip(kept, groups)]) for i in range(3))
        return q, doc, score

    def top(self, at: np.ndarray, weights: np.ndarray, k: int, least: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
        """``best`` for one query."""
        return self.best(np.array([0, len(at)]), at, weights, k, np.array([least]))[1:]


def _impact(tf: np.ndarray, damping: np.ndarray | float) -> np.ndarray:
    """What a term adds to a document's score, for each unit of its weight."""
    return tf * (K1 + 1) / (tf + damping)


def _ranges(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each begin on, as many as its size, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(begins - ends + sizes, sizes)


def _cuts(values: np.ndarray) -> list[tuple[int, int]]:
    """Begin and end of each run of equal values."""
    at = np.concatenate(([0], np.flatnonzero(np.diff(values)) + 1, [len(values)]))
    return list(zip(at[:-1].tolist(), at[1:].tolist())) if len(values) else []


class _Stretch:
    """The postings of neighbouring documents of a shard, and a row of 32-bit floats for each term that many have."""

    def __init__(self, shard: Shard, low: int, high: int, at: np.ndarray):
        self.low, self.width = low, high - low
        wanted = np.zeros(len(shard.terms), bool)
        wanted[at] = True
        inside = np.flatnonzero((shard.docs >= low) & (shard.docs < high))
        inside = inside[wanted[shard.term[inside]]]
        term = shard.term[inside]
        docs, impact = shard.docs[inside].astype(np.int32) - low, shard._impact(inside)
        self.counts = np.bincount(term, minlength=len(shard.terms))
        begins = np.cumsum(self.counts) - self.counts
        self.most = np.zeros(len(shard.terms), np.float32)
        held = np.flatnonzero(self.counts)
        if len(held):
            self.most[held] = np.maximum.reduceat(impact, begins[held])
        self._lay_out(held, term, docs, impact, begins)
        common = np.flatnonzero(self.counts * WORTH > self.width)
        if len(common) > COMMON:  # the others are added one by one
            common = np.sort(common[np.argpartition(-self.counts[common], COMMON)[:COMMON]])
        self.row = np.full(len(shard.terms), -1, np.int16)
        self.row[common] = np.arange(len(common))
        self.common_counts = self.counts[common]
        self.matrix = np.zeros((len(common), self.width), np.float32)
        of = self.row[term]
        here = np.flatnonzero(of >= 0)
        self.matrix[of[here], docs[here]] = impact[here]

    def _lay_out(self, held: np.ndarray, term: np.ndarray, docs: np.ndarray, impact: np.ndarray, begins: np.ndarray) -> None:
        """A table for each length of posting lists, its rows filled up with nothing: whole rows are taken at once."""
        self.kind, self.slot = np.zeros(len(begins), np.uint8), np.zeros(len(begins), np.int32)
        self.kind[held] = np.searchsorted(LENGTHS, self.counts[held])
        by_kind = held[np.argsort(self.kind[held], kind="stable")]
        lengths = LENGTHS[self.kind[by_kind]]
        ends = np.cumsum(lengths)
        shift = np.zeros(len(begins), np.int64)
        shift[by_kind] = ends - lengths - begins[by_kind]
        at = np.arange(len(term)) + shift[term]
        total = int(ends[-1]) if len(ends) else 0
        flat_docs, flat_impact = np.zeros(total, np.int64), np.zeros(total, np.float32)
        flat_docs[at], flat_impact[at] = docs, impact
        self.tables = {}
        for lo, hi in _cuts(self.kind[by_kind]):
            self.slot[by_kind[lo:hi]] = np.arange(hi - lo)
            part = slice(int(ends[lo] - lengths[lo]), int(ends[hi - 1]))
            self.tables[int(self.kind[by_kind[lo]])] = tuple(x[part].reshape(hi - lo, -1) for x in (flat_docs, flat_impact))

    def reach(self, query: np.ndarray, at: np.ndarray, weights: np.ndarray, k: int, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of query and document that may be among the best ``k`` of those that score ``least`` or more."""
        none = np.zeros(0, np.int64), np.zeros(0, np.int64)
        bound = np.bincount(query, weights=self.most[at] * weights, minlength=len(least)) * (1 + 1e-6)
        open_ = np.flatnonzero((bound > 0) & (bound >= least))
        if not len(open_):
            return none
        number = np.full(len(least), -1)
        number[open_] = np.arange(len(open_))
        here = np.flatnonzero((self.kind[at] > 0) & (number[query] >= 0))
        query, at, weights = number[query[here]], at[here], weights[here]
        row = self.row[at]
        use = np.bincount(row[row >= 0], minlength=len(self.matrix)) * self.common_counts * WORTH > len(open_) * self.width
        rows = np.flatnonzero(use)
        place = np.full(len(use) + 1, -1)  # the last for terms without a row
        place[rows] = np.arange(len(rows))
        column = place[row]
        dense, rest = np.flatnonzero(column >= 0), np.flatnonzero(column < 0)
        factors = np.zeros((len(open_), len(rows)), np.float32)
        factors[query[dense], column[dense]] = weights[dense]
        score = factors[:, :ROWS] @ self.matrix.take(rows[:ROWS], axis=0)
        for lo in range(ROWS, len(rows), ROWS):
            score += factors[:, lo:lo + ROWS] @ self.matrix.take(rows[lo:lo + ROWS], axis=0)
        if len(rest):
            cells, kind = score.reshape(-1), self.kind[at[rest]]
            few = query[rest] // FEW * len(LENGTHS) + kind  # the scores of a few queries stay in the processor's cache
            order = np.argsort(few.astype(np.uint16), kind="stable")
            rest, few, kind = rest[order], few[order], kind[order]
            base, factor, slot = query[rest] * self.width, weights[rest].astype(np.float32), self.slot[at[rest]]
            for low, high in _cuts(few):
                docs, impact = self.tables[int(kind[low])]
                step = max(1, POSTINGS // docs.shape[1])
                for lo in range(low, high, step):
                    part = slice(lo, min(lo + step, high))
                    cell, value = docs.take(slot[part], axis=0), impact.take(slot[part], axis=0)
                    cell += base[part, None]
                    value *= factor[part, None]
                    ADD.at(cells, cell.reshape(-1), value.reshape(-1))
        # at most that share is lost or won by rounding, as no summand is negative
        off = (np.bincount(query, minlength=len(open_)) + 16) * 2.0 ** -23
        bar = np.maximum(least[open_] * (1 - off), 1e-35)
        hit = score >= bar[:, None].astype(np.float32)
        crowded = np.flatnonzero(np.count_nonzero(hit, axis=1) > k)
        for many in (crowded[i:i + FEW] for i in range(0, len(crowded), FEW)):
            kth = np.partition(score[many], self.width - k, axis=1)[:, self.width - k]
            hit[many] = score[many] >= np.maximum(bar[many], kth * (1 - 2 * off[many]))[:, None].astype(np.float32)
        found, doc = np.divmod(np.flatnonzero(hit), self.width)
        return open_[found], doc + self.low


@dataclass(frozen=True)
class QueryBlock:
    """Queries as flat arrays: distinct terms, per query which of them with what weight, and the score to reach."""
    ids: np.ndarray
    offsets: np.ndarray
    terms: np.ndarray
    which: np.ndarray
    weights: np.ndarray
    least: np.ndarray


def _search(index: DataFrame, block: QueryBlock, average: float, k: int) -> DataFrame:
    shared = index.sparkSession.sparkContext.broadcast(block)  # QUERY_TERMS terms, about

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: (v.as_py() if name == "doc_ids" else v.as_buffer())
                       for name, v in ((n, batch.column(j)[i]) for j, n in enumerate(batch.schema.names))}
                shard = Shard(row, average)
                if not len(shard.terms):
                    continue
                at = np.minimum(np.searchsorted(shard.terms, q.terms), len(shard.terms) - 1).astype(np.int32)
                here = np.flatnonzero((shard.terms[at] == q.terms)[q.which])
                if not len(here):
                    continue
                offsets, at, weights = np.searchsorted(here, q.offsets), at[q.which[here]], q.weights[here]
                del here
                query, doc, score = shard.best(offsets, at, weights, k, q.least)
                if len(query):
                    yield pa.record_batch([pa.array(q.ids[query]), pa.array([shard.ids[d] for d in doc.tolist()], pa.int64()), pa.array(score)],
                                          ["query_id", "doc_id", "score"])

    return index.select("doc_ids", "lengths", "terms", "counts", "docs", "tf").mapInArrow(
        run, "query_id long, doc_id long, score double")


def _term_rows(rows: DataFrame) -> DataFrame:
    """``query_id, place, term, n`` of the queries' texts; neighbours by place have words in common."""
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in split_batch(batch.column(1), 2 << 20):
                hashes, at = word_hashes(batch.column(1).slice(lo, hi - lo))
                ids = batch.column(0).slice(lo, hi - lo).to_pylist()
                places = _places(hashes, at)
                for i, query in enumerate(ids):
                    terms, n = np.unique(hashes[at[i]:at[i + 1]], return_counts=True)
                    yield pa.record_batch([pa.array(np.full(len(terms), query, np.int64)), pa.array(np.full(len(terms), places[i])),
                                           pa.array(terms.view(np.int64)), pa.array(n)], ["query_id", "place", "term", "n"])
    return rows.mapInArrow(run, "query_id long, place long, term long, n long")


def _document_frequencies(index: DataFrame) -> DataFrame:
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for terms, counts in zip(batch.column(0), batch.column(1)):
                yield pa.record_batch([pa.array(np.frombuffer(terms.as_buffer(), "<i8")),
                                       pa.array(np.frombuffer(counts.as_buffer(), "<u4").astype(np.int64))], ["term", "df"])
    return (index.select("terms", "counts").mapInArrow(run, "term long, df long")
            .groupBy("term").agg(F.sum("df").alias("df")))


def search(docs: DataFrame, queries: DataFrame, scratch: Scratch, k: int = 10) -> DataFrame:
    """``query_id, rank, doc_id, score``: the best ``k`` documents of each query by BM25, exactly.

    ``queries`` has ``query_id, text``; of rows with one id the text of least hash counts. Words are
    runs of non-space bytes with A-Z lower-cased; a word that a query repeats counts as often. Scores use the
    number of documents, their mean length and the document frequencies of the whole table. Ties go to the
    smaller id, null ids last. Null and empty texts match nothing; a query without known words has
    no rows. Repeated rows are documents of their own; other columns are ignored.
    """
    turn = F.pmod(F.xxhash64("shard"), F.lit(ROUNDS[-1][1]))  # kept, so that a round reads few files of other rounds
    index = scratch.put(build_index(docs).withColumn("turn", turn))
    size = index.agg(F.coalesce(F.sum(F.size("doc_ids")), F.lit(0)).alias("n"), F.coalesce(F.sum("words"), F.lit(0)).alias("words")).first()
    n, average = size["n"], max(1.0, size["words"] / max(1, size["n"]))
    chosen = (queries.filter(F.col("query_id").isNotNull()).groupBy("query_id")
              .agg(F.min_by("text", F.xxhash64("text")).alias("text")))
    idf = F.log(F.lit(1.0) + (F.lit(float(n)) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighted = scratch.put(_term_rows(chosen).hint("merge").join(_document_frequencies(index), "term")
                           .select("query_id", "place", "term", (F.col("n") * idf).alias("weight")))
    blocks = max(1, -(-weighted.count() // QUERY_TERMS))
    schema, parts = "query_id long, doc_id long, score double", []
    for b in range(blocks):
        rows = weighted.filter(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == b).toArrow()  # a block of bounded size
        query, place, term, weight = (rows.column(i).to_numpy() for i in range(4))
        order = np.lexsort((term.view(np.uint64), query, place))
        query, term, weight = query[order], term[order].view(np.uint64), weight[order]
        offsets = np.concatenate(([0], np.flatnonzero(np.diff(query)) + 1, [len(query)] * bool(len(query)))).astype(np.int64)
        ids = query[offsets[:-1]]
        terms, which = np.unique(term, return_inverse=True)
        least, by_id = np.zeros(len(ids)), np.argsort(ids)
        del rows, place, term, order
        found = None
        for low, high in ROUNDS:
            block = QueryBlock(ids, offsets, terms, which.astype(np.int32), weight, least)
            more = scratch.put(_search(index.filter((F.col("turn") >= low) & (F.col("turn") < high)), block, average, k))
            found = more if found is None else found.unionByName(more)
            if (low, high) != ROUNDS[-1]:
                place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score")))
                reached = (found.withColumn("place", place).filter(F.col("place") == k)
                           .select("query_id", "score").toArrow())  # a row per query of the block
                least[by_id[np.searchsorted(ids, reached.column(0).to_numpy(), sorter=by_id)]] = reached.column(1).to_numpy()
        parts.append(found)
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("long").alias("rank"), "doc_id", "score"))


def op2_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document whose id is divisible by 100 is a query, with its whole text, against all documents."""
    scratch = Scratch(spark, "op2")
    docs = table(spark, sf_dir, "documents")
    queries = docs.filter(F.col("doc_id") % 100 == 0).select(F.col("doc_id").alias("query_id"), "text")
    return scratch.finish(search(docs, queries, scratch))
