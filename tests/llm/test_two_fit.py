"""Best-two-fit packing against one sequence after the other, and whole documents read back."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from test_operators import TEXTS, docs, none, scratch  # noqa: F401

from tapewatch.llm import two_fit
from tapewatch.llm.tokens import default_tokenizer, word_encoder


def one_by_one(counts, size):
    counts, out = Counter(counts), []
    while +counts:
        used, gap = Counter(), size
        while fit := [n for n in counts if n <= gap and counts[n] > used[n]]:
            used[max(fit)] += 1
            gap -= max(fit)
        while gap and sum(used.values()) > 1:
            shortest = min(+used)
            used[shortest] -= 1
            room = gap + shortest
            pairs = [(a + b, a, b) for a in counts for b in counts if b <= a and a + b <= room
                     and all(counts[x] - used[x] >= k for x, k in Counter((a, b)).items())]
            best = max(pairs, default=(0, 0, 0))
            if best[0] <= shortest:
                used[shortest] += 1
                break
            used.update(best[1:])
            gap = room - best[0]
        counts -= used
        out.append(sorted(used.elements()))
    return out


def test_bulk_fillings_equal_one_by_one():
    for seed in range(200):
        rnd = random.Random(seed)
        size = rnd.choice([1, 7, 12, 30, 64])
        counts = {rnd.randint(1, size): rnd.randint(1, 9) for _ in range(rnd.randint(0, 9))}
        assert [sorted(u.elements()) for u, times in two_fit.fillings(counts, size) for _ in range(times)] == one_by_one(counts, size)


def test_a_pair_replaces_the_shortest():
    # 50 + 30 leaves 20; 25 + 24 in place of 30 leaves 1
    assert next(two_fit.fillings({50: 1, 30: 1, 25: 1, 24: 1}, 100))[0] == Counter({50: 1, 25: 1, 24: 1})


def test_plan_of_billions_of_pieces():
    counts = {n: 10**9 + n for n in range(1, 2049)}
    plan = two_fit.Plan(counts, 2048)
    total = sum(n * c for n, c in counts.items())
    assert -(-total // 2048) <= plan.sequences <= 1.001 * total / 2048 and len(plan.first) < 20_000
    sequence, offset = plan.place(np.array([1000, 1000]), np.array([0, 10**9 + 999]))
    assert (offset <= 1048).all() and (sequence < plan.sequences).all()


@pytest.mark.parametrize("size", [16, 2048])
def test_pieces_hold_every_id_once(docs, none, scratch, size):  # noqa: F811
    encoder = word_encoder(default_tokenizer(), 0).tokenizer
    want = Counter()
    for doc_id, text, *_ in TEXTS:
        ids = [*encoder.encode(text or "", add_special_tokens=False).ids, 0]
        for piece in range(-(-len(ids) // size)):
            part = np.array(ids[piece * size:(piece + 1) * size], "<u4")
            want[doc_id, piece, piece * size, len(part), zlib.crc32(part.tobytes()), part.tobytes()] += 1
    rows = two_fit.pack(docs, scratch, size).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"], bytes(r["ids"])) for r in rows) == want
    places = defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    assert sorted(places) == list(range(len(places)))
    for held in places.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= size
    lengths = Counter(k[3] for k in want.elements())
    assert len(places) == len(one_by_one(lengths, size))
    assert two_fit.pack(none, scratch, size).count() == 0


def test_no_sequence_too_many(spark, sf):
    rows = two_fit.op12_best_two_fit(spark, sf).collect()
    ids = sum(r["length"] for r in rows)
    assert len({r["sequence_id"] for r in rows}) <= -(-ids // 2048) + 1
