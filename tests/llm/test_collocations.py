"""Phrase mining against brute force."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from test_operators import LOW, docs, none, scratch  # noqa: F401

from tapewatch.llm import collocations as c


def pieces(text):
    return [w for p in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)) if (w := re.findall(r"[^\x20\x09]+", p))]


def brute(rows, longest, least, share, first):
    f = Counter((lang or "und", *w[i:i + m]) for lang, text in rows for w in pieces(text)
                for m in range(1, longest + 1) for i in range(len(w) - m + 1))
    candidates = {k: a for k, a in f.items() if len(k) > 2 and a >= least}
    around = Counter()
    for (lang, *w), a in candidates.items():
        for m in range(2, len(w)):
            for i in range(len(w) - m + 1):
                key = (lang, *w[i:i + m])
                around[key] = max(around[key], a)
    out = {}
    for (lang, *w), a in candidates.items():
        if 100 * around[(lang, *w)] < share * a or not around[(lang, *w)]:
            cuts = [(2000000 * a // (f[(lang, *w[:k])] + f[(lang, *w[k:])]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[(lang, *w[:k])], f[(lang, *w[k:])]))
    n = Counter()
    for k, a in f.items():
        n[k[0]] += a if len(k) == 2 else 0
    return sorted((lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for lang, rows in out.items()
                  for i, (s, a, p, l, r) in enumerate(sorted(rows)[:first]))


@pytest.mark.parametrize("longest, least, share, first", [(4, 2, 80, 2000), (3, 1, 50, 7), (2, 3, 100, 3)])
def test_collocations_equal_brute_force(spark, docs, scratch, longest, least, share, first):  # noqa: F811
    rnd = np.random.default_rng(5)
    texts = [" ".join(rnd.choice(["the", "Cat", "sat", "on.", "mat", "é", "on;", "\t", "\n"], 40)) for _ in range(60)]
    rows = [(r["lang"], r["text"]) for r in docs.collect() if len(r["text"] or "") < 10**5]
    rows += [(["en", "de", None, "und"][i % 4], t) for i, t in enumerate(texts)] + [("en", "of the of the of the of the")]
    frame = spark.createDataFrame([(a, b, "clash", 1) for a, b in rows], "lang string, text string, word string, shard int").repartition(5)
    got = sorted(tuple(r) for r in c.collocations(frame, scratch, longest, least, share, first).collect())
    assert got == brute(rows, longest, least, share, first)


def test_a_very_long_text_and_no_rows(docs, none, scratch):  # noqa: F811
    got = sorted(tuple(r) for r in c.collocations(docs, scratch, least=8).collect())
    assert got == brute([(r["lang"], r["text"]) for r in docs.collect()], 4, 8, 80, 2000)
    empty = c.collocations(none, scratch)
    assert empty.count() == 0 and empty.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    with pytest.raises(ValueError):
        c.phrases(none, scratch, 5)


def test_products_beyond_64_bits(spark):
    f = 9 * 10**17
    row = spark.sql(f"SELECT (CAST(2000000 AS decimal(38,0)) * {f}L) div ({f}L + {f + 1}L) AS score").first()
    assert row["score"] == 2000000 * f // (f + f + 1)


def test_words_of_a_batch():
    words, row, begins = c.split_words(pa.array(["A b,c", None, "", " ;; ", "é\x0bZ\tz\x00"]))
    assert words.to_pylist() == ["a", "b", "c", "é", "z", "z\x00"]
    assert row.tolist() == [0, 0, 0, 4, 4, 4] and begins.tolist() == [True, False, True, True, True, False]


def test_intervals_count_all_phrases():
    rnd = np.random.default_rng(2)
    symbols = np.concatenate([[0], rnd.integers(0, 4, 500)]).astype(np.int32)
    index = c.Index(c.transform(symbols, 4))
    ring = np.concatenate([symbols, symbols[:4]]).tolist()
    for depth in range(2, 5):
        numbers = np.arange(index.intervals)
        _, counts, _, _ = index.extend(numbers)
        want = Counter(tuple(ring[i:i + depth]) for i in range(len(symbols)))
        assert counts.tolist() == [want[k] for k in sorted(want)]
