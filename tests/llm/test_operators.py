"""Edge rows and brute-force comparisons of the operators over documents."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from math import log

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tapewatch.llm import (exact_dedup, language_id, line_dedup, mixing, near_dedup, packing, repeats, search, token_counts,
                           token_files)
from tapewatch.llm.common import KeyFilter, Scratch
from tapewatch.llm.components import components
from tapewatch.llm.tokens import WordEncoder, default_tokenizer, word_encoder

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, ids string, length double, row string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = " ".join(f"w{i % 977} x{i % 1013}" for i in range(30_000))
PASSAGE = "\n".join(f"line {i} of a passage that many share, {i * i}" for i in range(12))

TEXTS = [
    (1, "The cat sat on the mat.\nIt was a fine day, was it not?", "en", "a"), (2, None, "en", "a"), (3, "", None, None), (4, "  \t\n ", "de", "b"),
    (5, "The cat  sat on the mat.\nIt was a fine day,\twas it not?", "en", None), (6, LONG, "en", "b"), (7, LONG + " end", "en", "b"),
    (8, PASSAGE, "fr", "c"), (9, "before\n" + PASSAGE + "\nafter", "fr", "é"), (10, "12 34 !!", "fr", "a"), (11, "ÀÉ ß \U0001F600 ́ 中文", "de", "b"),
    (None, "no id here", "en", "a"), (None, "no id here", "en", "a"), (12, "twice", "en", "a"), (12, "twice", "en", "a"),
    (12, "twice but not the same", "en", "a"), (13, "<|endoftext|> # ## text", "en", "a"), (14, "one", "en", "z"), (15, PASSAGE, "fr", "c")]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(d, t, lang, s, len(t) if t else None, "clash", 1.5, "clash") for d, t, lang, s in TEXTS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def scratch(spark):
    return Scratch(spark, "test")


def words(text):
    return WORD.findall((text or "").translate(LOW))


# ---- helpers --------------------------------------------------------------------------------

def test_key_filter_lets_no_member_go(spark):
    members = spark.range(0, 1000).withColumnRenamed("id", "key")
    held = KeyFilter(members, "key", bits=1 << 16)
    inside = held.test(np.arange(1000).astype(np.uint64))
    outside = held.test(np.arange(10**6, 10**6 + 1000).astype(np.uint64))
    assert inside.all() and outside.sum() < 100
    assert not KeyFilter(members.limit(0), "key", bits=1 << 16).test(np.arange(9, dtype=np.uint64)).any()


def test_components_of_chains_stars_and_rings(spark, scratch):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(8, 40)] + [(200, 201), (201, 202), (202, 200), (5, 5)]
    found = {r["u"]: r["v"] for r in components(spark.createDataFrame(edges, "u long, v long"), scratch).collect()}
    want = {i: 100 for i in range(101, 161)} | {i: 7 for i in range(8, 40)} | {201: 200, 202: 200}
    assert found == want
    assert components(spark.createDataFrame([], "u long, v long"), scratch).count() == 0


def test_word_encoder_equals_the_library():
    encoder, rnd = WordEncoder(default_tokenizer(), 2), random.Random(3)
    alphabet = [*"abcXYZ's'T'll019éÉßÀ×÷#$.,\n\t\x0b\x1c\u0085 ́ Σİﬁ中", "<|endoftext|>", "don't", "ǅ", " "]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60))) for _ in range(1500)] + [None, "", "  "]
    ids, at = encoder.encode(pa.array(texts))
    want = [e.ids + [2] for e in encoder.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == want


# ---- 1 mixing -------------------------------------------------------------------------------

def test_plain_words_need_the_model_alone():
    rnd = random.Random(5)
    letters = [chr(c) for c in [*range(0x21, 0x7F), *range(0xC0, 0x100)] if c not in (0xD7, 0xF7)]
    texts = [" ".join("".join(rnd.choices(letters, k=rnd.randint(1, 9))) for _ in range(2_500)).replace("<|", "<") for _ in range(4)]
    texts.append("it's They'LL ''s 'n' x'sé ÀÉÎ 12a3 --a-- ' ''")
    encoder = WordEncoder(default_tokenizer(), 2)
    library = encoder.tokenizer
    encoder.tokenizer = type("", (), {"model": library.model})()
    ids, at = encoder.encode(pa.array(texts))
    for i, text in enumerate(texts):
        assert ids[at[i]:at[i + 1]].tolist() == library.encode(text, add_special_tokens=False).ids + [2]


def test_mix_takes_each_budget(spark, docs, none, scratch):
    sized, plan = mixing.mix_plan(docs, scratch, range_rows=2)
    rows = mixing.with_plan(sized, plan).collect()
    assert len(rows) == len(TEXTS)
    by = defaultdict(list)
    for r in rows:
        by[r["source"]].append(r)
    assert {s for s in by} == {"a", "b", "c", "z", "é", None}
    total = sum(r["size"] for r in rows)
    assert total == sum(len(words(t[1])) for t in TEXTS)
    for mine in by.values():
        size, taken, target = sum(r["size"] for r in mine), sum(r["taken"] for r in mine), mine[0]["target"]
        assert mine[0]["source_size"] == size and target <= 2 * size
        assert target - len(mine) - 1 <= taken <= target and all(r["taken"] <= 2 * r["size"] for r in mine)
    assert sum(m[0]["target"] for m in by.values()) == pytest.approx(1.5 * total)
    again = mixing.with_plan(*mixing.mix_plan(docs.repartition(5), scratch)).collect()
    assert Counter((r["doc_id"], r["size"], r["taken"]) for r in again) == Counter((r["doc_id"], r["size"], r["taken"]) for r in rows)
    assert mixing.mix(none).count() == 0 and mixing.mix(none).columns == none.columns


def test_mixed_corpus_has_the_words_of_the_plan(docs, scratch):
    plan = mixing.with_plan(*mixing.mix_plan(docs, scratch)).collect()
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    rows, taken = mixed.collect(), Counter()
    for r in rows:
        taken[r["doc_id"]] += len(words(r["text"]))
    want = Counter()
    for r in plan:
        want[r["doc_id"]] += r["taken"]
    assert +taken == +want and all(r["ids"] == "clash" for r in rows)


def test_a_target_that_is_stopped_goes_to_the_others(spark, scratch):
    rows = [(i, "w " * n, s) for i, (n, s) in enumerate([(10, "a"), (1000, "b"), (1000, "c"), (5, "d")])]
    sized, plan = mixing.mix_plan(spark.createDataFrame(rows, "doc_id long, text string, source string"), scratch)
    targets = {r["source"]: r["target"] for r in plan.collect()}
    rest = 1.5 * 2015 - 20 - 10  # a (weight 3) and d (weight 3) stop at twice their size; b has 1, c has 2
    assert targets["a"] == 20 and targets["d"] == 10
    assert targets["c"] == pytest.approx(min(2000, rest * 2 / 3)) and targets["b"] == pytest.approx(rest - targets["c"])


def test_sources_of_equal_size_share_one_level(spark, scratch):
    rows = [(i, "w " * 100, f"s{i}") for i in range(7)]  # weights 3, 1, 2, 3, 1, 2, 3; the two of weight 2 tie
    for parts in (1, 5):
        table = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(parts)
        targets = {r["source"]: r["target"] for r in mixing.mix_plan(table, scratch)[1].collect()}
        assert targets == {"s0": 200, "s1": 75, "s2": 150, "s3": 200, "s4": 75, "s5": 150, "s6": 200}


# ---- 2 search -------------------------------------------------------------------------------

def brute_bm25(rows, queries, k):
    bags = [(d, Counter(words(t))) for d, t in rows]
    df = Counter(w for _, c in bags for w in c)
    n, average = len(bags), max(1.0, sum(sum(c.values()) for _, c in bags) / len(bags))
    out = {}
    for q, text in queries:
        scores = []
        for d, c in bags:
            size = sum(c.values())
            s = sum(m * log(1 + (n - df[w] + .5) / (df[w] + .5)) * c[w] * 2.2 / (c[w] + 1.2 * (.25 + .75 * size / average))
                    for w, m in Counter(words(text)).items() if w in c)
            if s > 0:
                scores.append((-round(s, 9), d is None, d))
        out[q] = sorted(scores)[:k]
    return out


def test_search_equals_brute_force(spark, docs, none, scratch, monkeypatch):
    rnd = random.Random(1)
    rows = [(i, " ".join(f"t{int(rnd.paretovariate(.7)) % 300}" for _ in range(rnd.randint(0, 40)))) for i in range(900)]
    rows += [(d, t) for d, t, *_ in TEXTS if d is None or d > 20] + [(1000, rows[5][1]), (1001, rows[5][1]), (1002, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    queries = [(q, rows[q][1]) for q in range(0, 900, 60)] + [(5000, "nothing known"), (5001, None), (5002, rows[5][1])]
    monkeypatch.setattr(search, "QUERY_TERMS", 250)  # several blocks of queries
    found = search.search(table, spark.createDataFrame(queries, "query_id long, text string"), scratch, k=7).collect()
    got = defaultdict(list)
    for r in sorted(found, key=lambda r: r["rank"]):
        got[r["query_id"]].append((-round(r["score"], 9), r["doc_id"] is None, r["doc_id"]))
    want = {q: w for q, w in brute_bm25(rows, queries, 7).items() if w}
    assert set(got) == set(want)
    for q in want:
        assert [x[2] for x in got[q]] == [x[2] for x in want[q]]
        assert [x[0] for x in got[q]] == pytest.approx([x[0] for x in want[q]])
    assert search.search(none, none.selectExpr("doc_id AS query_id", "text"), scratch).count() == 0
    assert search.search(docs, docs.selectExpr("doc_id AS query_id", "text"), scratch).filter("rank = 1").count() > 5


def test_pruned_search_finds_what_all_blocks_hold():
    rnd = np.random.default_rng(2)
    hashes = [np.sort(rnd.integers(0, 50, rnd.integers(1, 30)).astype(np.uint64) * np.uint64(7919)) for _ in range(2000)]
    row = search._index_row(0, hashes, np.array([len(h) for h in hashes]), list(range(2000))).to_pylist()[0]
    shard = search.Shard({k: v for k, v in row.items()}, 15.0)
    for _ in range(20):
        at = np.unique(rnd.integers(0, len(shard.terms), 5))
        weights = rnd.random(len(at)) ** 4
        every = shard._score(at, weights, None, weights)
        docs, scores = shard.top(at, weights, 10)
        want = [d for d in np.lexsort((np.array(shard.ids), -every))[:10] if every[d] > 0]
        assert docs.tolist() == want and np.array_equal(scores, every[docs])
        above = shard.top(at, weights, 10, scores[3])
        assert above[0].tolist() == [d for d in want if every[d] >= scores[3]]


def test_groups_of_queries_find_what_single_scores_hold(monkeypatch):
    rnd = np.random.default_rng(5)
    hashes = [np.minimum(rnd.zipf(1.3, rnd.integers(0, 60)), 3000).astype(np.uint64) * np.uint64(7919) for _ in range(700)]
    hashes += [hashes[3]] * 200  # equal texts tie
    ids = [None if i % 50 == 7 else 5000 - i for i in range(900)]
    row = search._index_row(0, hashes, np.array([len(h) for h in hashes]), ids).to_pylist()[0]
    shard = search.Shard(row, 30.0)
    bags = [np.unique(rnd.integers(0, len(shard.terms), rnd.integers(1, 40))) for _ in range(60)]
    bags.append(np.flatnonzero(np.isin(shard.terms, hashes[3])))
    offsets, at = np.cumsum([0] + [len(b) for b in bags]), np.concatenate(bags)
    weights = rnd.random(len(at)) ** 3
    every = [shard._score(at[a:b], weights[a:b]) for a, b in zip(offsets, offsets[1:])]
    wants = [[d for d in np.lexsort((shard.tie, -x))[:10] if x[d] > 0] for x in every]
    reached = np.array([x[w[3]] if len(w) > 3 and i % 2 else 0.0 for i, (x, w) in enumerate(zip(every, wants))])
    for sizes in ({}, {"STRETCH": 64, "GROUP": 7, "POSTINGS": 16, "FEW": 2}, {"WORTH": 1}, {"WORTH": 10**6, "COMMON": 50, "GROUP_TERMS": 100}):
        with monkeypatch.context() as patch:
            for name, value in sizes.items():
                patch.setattr(search, name, value)
            for least in (np.zeros(len(bags)), reached):
                query, doc, score = shard.best(offsets, at, weights, 10, least)
                for i, (x, want) in enumerate(zip(every, wants)):
                    assert doc[query == i].tolist() == [d for d in want if x[d] >= least[i]]
                    assert np.array_equal(score[query == i], x[doc[query == i]])


def test_postings_of_common_terms_are_not_added_one_by_one(monkeypatch):
    rnd = np.random.default_rng(6)
    hashes = [np.unique(rnd.zipf(1.2, 300) % 20_000).astype(np.uint64) for _ in range(2000)]
    shard = search.Shard(search._index_row(0, hashes, np.array([len(h) for h in hashes]), list(range(2000))).to_pylist()[0], 150.0)
    bags = [np.searchsorted(shard.terms, np.sort(hashes[i])) for i in range(0, 2000, 5)]
    at, added = np.concatenate(bags), []
    add = np.add.at

    class Counted:
        @staticmethod
        def at(cells, cell, value):
            added.append(np.count_nonzero(value))
            add(cells, cell, value)

    monkeypatch.setattr(search, "ADD", Counted)
    shard.best(np.cumsum([0] + [len(b) for b in bags]), at, np.ones(len(at)), 10, np.zeros(len(bags)))
    assert 0 < sum(added) < shard.counts[at].sum() / 8


# ---- 3 exact dedup --------------------------------------------------------------------------

@pytest.mark.parametrize("n,universe", [(0, 10), (1, 1), (1, 1 << 40), (1000, 1 << 44), (1000, 1500)])
def test_golomb_round_trip(n, universe):
    values = np.sort(np.random.default_rng(n).choice(min(universe, 1 << 30), n, replace=False)).astype(np.uint64)
    code = exact_dedup.golomb_encode(values, universe)
    assert np.array_equal(exact_dedup.golomb_decode(code), values)
    assert len(code) < 8 * n + 32


def test_exact_dedup_edges(docs, none, monkeypatch):
    rows = exact_dedup.exact_dedup(docs).collect()
    assert len(rows) == len(TEXTS)
    groups = defaultdict(list)
    for d, t, *_ in TEXTS:
        groups[re.sub(r"[\x20\x09-\x0D]+", "", t or "")].append((-len(t or ""), d is None, d))
    want = Counter()
    for text, members in groups.items():
        keep = min(members)[2]
        for _, _, d in members:
            want[d, keep, len(members), hashlib.sha256(text.encode()).hexdigest()] += 1
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in rows) == want
    assert sum(r["kept"] for r in rows) == len(groups)
    assert exact_dedup.exact_dedup(none).count() == 0


# ---- 4, 6 token files -----------------------------------------------------------------------

def encoded(text, end=2, ordinary=False):
    encoder = word_encoder(default_tokenizer(), end, ordinary)
    return np.array(encoder.tokenizer.encode(text or "", add_special_tokens=False).ids + [end], "<u4")


@pytest.mark.parametrize("n,kinds", [(0, 5), (1, 1), (5, 3), (1000, 40_000), (130, 2), (70_000, 49_000)])
def test_huffman_round_trip(n, kinds):
    ids = (np.random.default_rng(n).zipf(1.3, n) % kinds).astype(np.uint32)
    lengths = token_files.limited_lengths(np.bincount(ids, minlength=kinds), 18)
    code = token_files.Code(lengths)
    payload, marks = code.encode(ids)
    assert np.array_equal(code.decode(payload, n, marks), ids)
    assert lengths.max(initial=0) <= 18 and (n < 2 or np.sum(0.5 ** lengths[lengths > 0].astype(float)) <= 1)


def test_limited_lengths_are_optimal_when_the_limit_is_wide():
    assert token_files.limited_lengths(np.array([1, 1, 2, 4, 0, 8])).tolist() == [4, 4, 3, 2, 0, 1]
    assert token_files.limited_lengths(np.array([1, 1, 2, 4, 8]), 3).tolist() == [3, 3, 3, 3, 1]


def test_token_files_round_trip(docs, none, scratch):
    manifest, lengths = token_files.huffman_files(docs, scratch, block_ids=50)
    rows = token_files.read_files(manifest, lengths).collect()
    assert Counter((r["doc_id"], bytes(r["ids"])) for r in rows) == Counter((d, encoded(t).tobytes()) for d, t, *_ in TEXTS)
    at = 0
    ordered = sorted(rows, key=lambda r: r["start"])
    for r in ordered:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"]) // 4
        at += r["n_tokens"]
    ids = [r["doc_id"] for r in ordered]
    assert ids == sorted(ids, key=lambda d: (d is not None, d))
    manifest, lengths = token_files.huffman_files(none, scratch)
    assert manifest.count() == 0 and token_files.read_files(manifest, lengths).count() == 0


def test_token_counts_stitch_blocks(spark, docs, none, scratch, monkeypatch):
    tokenizer, width = default_tokenizer(), "<u2"
    end = word_encoder(tokenizer, 0).tokenizer.token_to_id(token_counts.END)
    monkeypatch.setattr(token_counts, "SPAN", 3)
    for name, table in (("all", docs), ("none", none)):
        written = scratch.put(token_counts.write_flat(table, f"{scratch.root}/flat-{name}", tokenizer, end, width))
        files = written.groupBy("file").agg({"bytes": "sum"}).toDF("file", "bytes")
        for block in (64, 4096):
            counts = token_counts.token_counts(files, scratch, end, width, block_bytes=block).collect()
            assert sorted(r["n_tokens"] for r in counts) == (sorted(len(encoded(t, end, True)) for _, t, *_ in TEXTS)
                                                             if name == "all" else [])
            assert all(r["ended"] for r in counts)


def test_token_counts_of_an_unfinished_file(spark, scratch, tmp_path):
    path = f"file://{tmp_path}/x.ids"
    (tmp_path / "x.ids").write_bytes(np.array([9, 5, 5, 9, 9, 7, 7], "<u2").tobytes() + b"\1")
    files = spark.createDataFrame([(path, 15), ("file:///nowhere", 0)], "file string, bytes long")
    for block in (2, 6, 100):
        rows = token_counts.token_counts(files, scratch, 9, "<u2", block).orderBy("ordinal").collect()
        assert [(r["ordinal"], r["start"], r["n_tokens"], r["ended"]) for r in rows] == [
            (0, 0, 1, True), (1, 1, 3, True), (2, 4, 1, True), (3, 5, 2, False)]


# ---- 5 near-dedup ---------------------------------------------------------------------------

def shingles(text, k):
    w = words(text)
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def brute_components(rows, k):
    sets = [(d, shingles(t, k)) for d, t in rows]
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(sets)):
        for j in range(i):
            a, b = sets[i][1], sets[j][1]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, s) in enumerate(sets):
        if s and d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return Counter((d, len(s), least.get(root(i)) if s else d) for i, (d, s) in enumerate(sets))


def near_copies(n=150):
    rnd = random.Random(9)
    base = [f"w{rnd.randrange(400)}" for _ in range(120)]
    out = []
    for i in range(n):
        copy = list(base)
        for _ in range(rnd.randint(0, 12)):
            copy[rnd.randrange(len(copy))] = f"n{rnd.randrange(10_000)}"
        out.append((1000 + i, " ".join(copy)))
    return out


@pytest.mark.parametrize("k", [2, 5])
def test_near_dedup_equals_brute_force(spark, docs, none, k):
    rows = [(d, t) for d, t, *_ in TEXTS] + near_copies()
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = near_dedup.near_duplicates(table, words=k, cell=16).collect()  # a group of many cells
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == brute_components(rows, k)
    kept = [r["doc_id"] for r in found if r["kept"]]
    assert all(r["component_id"] == r["doc_id"] for r in found if r["kept"]) and kept.count(12) == 1
    assert near_dedup.near_duplicates(none, words=k).count() == 0
    stay = near_dedup.drop_near_duplicates(docs, words=k)
    assert stay.columns == docs.columns and {r["doc_id"] for r in stay.collect()} >= {1, 2, 3, 4, 6, 8, 10, 11, 12, 13, 14}


def test_unlinked_documents_stay_whatever_their_id(spark):
    rows = [(None, f"text {i} is like no other {i * i} one {i + 7}") for i in range(20)] + [(None, None), (None, ""), (7, None), (7, " ")]
    rows += [(12, "twice"), (12, "twice"), (12, "twice but not the same"), (None, "twice"), (None, "copied"), (None, "copied")]
    stay = near_dedup.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    want = Counter(rows) - Counter([(12, "twice"), (None, "twice"), (None, "copied")])
    assert Counter((r["doc_id"], r["text"]) for r in stay.collect()) == want


def test_shingles_of_a_batch_take_the_memory_of_a_piece():
    import tracemalloc
    rnd = random.Random(9)
    texts = pa.array([" ".join(rnd.choices(["alpha", "be", "gamma", "d"], k=400)) for _ in range(4_000)])
    assert texts.nbytes > 6 << 20
    tracemalloc.start()
    whole = [near_dedup.set_keys(values, at)[0] for _, _, values, at in near_dedup.piece_sets(texts, 5)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 * near_dedup.PIECE_BYTES < 64 << 20
    assert np.concatenate(whole).tolist() == near_dedup.set_keys(*near_dedup.shingle_sets(texts, 5))[0].tolist()


def test_sketches_estimate_similarity():
    rnd = np.random.default_rng(4)
    pool = rnd.integers(1, 1 << 62, 3000).astype(np.uint64)
    for size, common in ((3, 3), (40, 30), (2000, 1500)):
        a, b = np.sort(pool[:size]), np.sort(np.concatenate((pool[:common], pool[size:2 * size - common])))
        values = np.concatenate((a, b))
        one, two = near_dedup.sketches(values, np.array([0, len(a), len(values)]))
        truth = common / (2 * size - common)
        assert abs((one == two).mean() - truth) < 0.16


# ---- 7 line dedup ---------------------------------------------------------------------------

def brute_lines(rows):
    places, order = defaultdict(set), {}
    cut = []
    for d, t in rows:
        lines, chunks = line_dedup.long_chunks(t)
        cut.append((d, t, lines, chunks))
        for number, lo, hi, _ in chunks:
            places["\n".join(lines[lo:hi])].add((d is None, d or 0, number))
    out = Counter()
    for d, t, lines, chunks in cut:
        gone = [(lo, hi) for number, lo, hi, _ in chunks if min(places["\n".join(lines[lo:hi])]) != (d is None, d or 0, number)]
        kept = [line for i, line in enumerate(lines) if not any(lo <= i < hi for lo, hi in gone)]
        out[d, len(lines), sum(hi - lo for lo, hi in gone), "\n".join(kept) if t is not None else None] += 1
    return out


def test_line_dedup_equals_brute_force(docs, none, scratch):
    out = line_dedup.drop_repeated_lines(docs, scratch)
    assert out.columns == [*docs.columns, "lines", "lines_removed"]
    want = brute_lines([(d, t) for d, t, *_ in TEXTS])
    assert Counter((r["doc_id"], r["lines"], r["lines_removed"], r["text"]) for r in out.collect()) == want
    assert sum(k[2] for k in want) >= 12
    assert line_dedup.drop_repeated_lines(none, scratch).count() == 0


def test_passages_of_rows_without_an_id_of_their_own(spark, scratch):
    for doc_id in (None, 3):
        rows = [(doc_id, PASSAGE), (doc_id, PASSAGE + "\nanother end")]  # the same chunks at the same numbers
        out = line_dedup.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"), scratch).collect()
        chunks = [hi - lo for _, lo, hi, _ in line_dedup.long_chunks(PASSAGE)[1]]
        assert sum(r["lines_removed"] for r in out) >= sum(chunks[:-1]) > 0
        assert sorted(r["lines_removed"] > 0 for r in out) == [False, True]


def test_boundaries_do_not_shift():
    lines = PASSAGE.split("\n")
    inside = line_dedup.chunk_bounds(lines)
    shifted = line_dedup.chunk_bounds(["new", "lines", *lines])
    assert {(lo + 2, hi + 2) for lo, hi in inside[1:]} <= set(shifted)


# ---- 8 repeated strings ---------------------------------------------------------------------

def brute_repeats(texts, length):
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = True
        runs = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((len(t), int(gone.sum()), runs, bytes(np.frombuffer(t, np.uint8)[~gone])))
    return out


@pytest.mark.parametrize("limit", [100_000, 2])
def test_repeats_equal_brute_force(spark, scratch, limit):
    rnd = random.Random(5)
    base = ["".join(rnd.choice("ab") for _ in range(80)) for _ in range(6)]
    texts = ["".join(rnd.choice(base) if rnd.random() < .7 else "".join(rnd.choice("abé") for _ in range(rnd.randint(1, 30)))
                     for _ in range(rnd.randint(0, 8))) for _ in range(120)]
    texts += ["a" * 300, None, "", "ab" * 100, "x" * 60, "\0" * 90, "y" * 59]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = repeats.drop_repeats(table, scratch, length=60, gram=16, limit=limit).collect()
    got = {r["doc_id"]: (r["n_bytes"], sum(s["hi"] - s["lo"] for s in r["removed"]), len(r["removed"]), bytes(r["kept"])) for r in found}
    assert [got[i] for i in range(len(texts))] == brute_repeats([(t or "").encode() for t in texts], 60)


def test_repeats_edges(docs, none, scratch):
    found = repeats.drop_repeats(docs, scratch).collect()
    want = brute_repeats([(t or "").encode() for _, t, *_ in TEXTS if t != LONG and t != LONG + " end"], 400)
    got = Counter((r["n_bytes"], sum(s["hi"] - s["lo"] for s in r["removed"])) for r in found if r["n_bytes"] < 100_000)
    assert got == Counter(w[:2] for w in want)
    assert all(len(r["kept"]) < 400 for r in found if r["n_bytes"] > 100_000)
    assert repeats.drop_repeats(none, scratch).count() == 0


def test_intervals_of_a_known_list():
    # ab, abc, abd, b, bc with common prefixes 2, 2, 0, 1
    assert sorted(repeats.intervals([0, 2, 2, 0, 1], 1)) == [(1, 3, 4), (2, 0, 2)]


# ---- 9 packing ------------------------------------------------------------------------------

def test_hilbert_curve_visits_neighbours():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3), -1).reshape(-1, 3)
    key = packing.hilbert_key(grid, 3)
    path = grid[np.argsort(key)]
    assert sorted(key) == list(range(512)) and (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


@pytest.mark.parametrize("size", [16, 4096])
def test_packing_holds_every_id_once(docs, none, scratch, size):
    pieces = packing.pack(docs, scratch, size).collect()
    by_sequence = defaultdict(list)
    for r in pieces:
        assert len(r["ids"]) == 4 * r["length"] > 0
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"], bytes(r["ids"])))
    total, stream = 0, b""
    for number in sorted(by_sequence):
        at = 0
        for offset, length, ids in sorted(by_sequence[number]):
            assert offset == at
            at += length
            stream += ids
        assert at <= size and at & (at - 1) == 0  # full, or a power of two: nothing is padded
        total += at
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    assert total == sum(len(encoded(t)) for _, t, *_ in TEXTS)
    whole = [encoded(t) for d, t, *_ in TEXTS if d == 6][0]
    mine = sorted((r["start"], bytes(r["ids"])) for r in pieces if r["doc_id"] == 6)
    assert b"".join(i for _, i in mine) == whole.tobytes() and zlib.crc32(stream)
    assert packing.pack(none, scratch).count() == 0


# ---- 10 language ID -------------------------------------------------------------------------

def test_language_id_on_held_out_rows(spark, sf):
    rows = language_id.op10_language_id(spark, sf).collect()
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    assert len(rows) == len(truth)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) >= 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_id_edges(spark, docs, none, scratch):
    model = language_id.fit(docs, scratch)
    assert model.languages and sum(len(f) for f in model.families) == len(model.languages)
    rows = language_id.identify(docs, model)
    assert rows.columns == [*docs.columns, "lang_pred", "score"]
    found = rows.collect()
    assert len(found) == len(TEXTS)
    for r in found:
        if r["doc_id"] in (2, 3, 4, 10):
            assert r["lang_pred"] == "und" and r["score"] == 0
        else:
            assert r["lang_pred"] in model.languages
    nothing = language_id.fit(none, scratch)
    assert nothing.languages == ()
    assert {r["lang_pred"] for r in language_id.identify(docs, nothing).collect()} == {"und"}
    assert language_id.identify(none, model).count() == 0
    single = language_id.fit(docs.filter("lang = 'en'"), scratch)
    assert single.languages == ("en",) and language_id.identify(docs.filter("doc_id = 14"), single).first()["lang_pred"] == "en"
    assert language_id.drop_unidentified(docs, scratch).columns == docs.columns


def test_without_labels_texts_with_letters_stay(spark, docs, scratch):
    for bare in (docs.withColumn("lang", F.lit(None).cast("string")), docs.withColumn("doc_id", F.lit(None).cast("long"))):
        left = language_id.drop_unidentified(bare, scratch)
        assert left.columns == bare.columns
        want = Counter(t for _, t, *_ in TEXTS if t and any(c.isalpha() for c in t))
        assert Counter(r["text"] for r in left.collect()) == want


def test_the_prediction_looks_at_the_text_alone(spark, docs, scratch):
    model = language_id.fit(docs, scratch)
    renamed = docs.selectExpr("doc_id + 1 AS doc_id", "text", "'xx' AS lang", "'y' AS source")
    one = Counter((r["text"], r["lang_pred"]) for r in language_id.identify(docs, model).collect())
    assert one == Counter((r["text"], r["lang_pred"]) for r in language_id.identify(renamed, model).collect())
