"""Whitening against dense linear algebra."""

from collections import Counter

import numpy as np
import pytest
from test_operators import scratch  # noqa: F401

from tapewatch.llm import whitening as w
from tapewatch.llm.jacobi_davidson import largest_eigenpairs, minres

SCHEMA = "vec_id long, embedding array<float>, label int, component int, n string"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, 1, 2, "clash") for i, v in vectors], SCHEMA).repartition(3)


def brute(vectors, components=16):
    """Ids, whole vectors, eigenvalues, vectors, covariance trace and exact deviations, by eigh."""
    rows = [(i, np.floor(64 * np.array(v, np.float32).astype(float)).astype(int) + 1_000_000) for i, v in vectors
            if v is not None and all(c is not None and np.isfinite(np.float32(c)) for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in rows}))
    n, total = len(fit), fit.sum(axis=0)
    apart = (n * fit - total) / n
    values, directions = np.linalg.eigh(apart.T @ apart / n)
    order = np.argsort(-values)[:components]
    deviations = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(x, total)) for _, x in rows]
    whitened = np.array([(n * x - total) / n for _, x in rows]) @ directions[:, order] / np.sqrt(np.maximum(values[order], 1e-300))
    return rows, n, values[order], values.sum(), deviations, whitened


@pytest.fixture(scope="module")
def vectors():
    rnd = np.random.default_rng(3)
    some = rnd.standard_normal((400, 24)) * np.geomspace(3, 0.3, 24)
    rows = [(i, v.tolist()) for i, v in enumerate(some)]
    rows += [(7, some[7].tolist()), (None, some[8].tolist()), (None, some[8].tolist())] + [(500 + i, some[0].tolist()) for i in range(300)]
    return rows + [(1000, None), (1001, [None] + [1.0] * 23), (1002, [float("nan")] * 24), (1003, [float("inf")] * 24), (1004, [1.0]), (1005, [])]


def test_whitening_equals_eigh(spark, vectors, scratch):  # noqa: F811
    whole = [r for r in vectors if r[0] not in (1004, 1005)]
    rows, n, values, trace, deviations, whitened = brute(whole)
    got = w.whiten(frame(spark, vectors), scratch).collect()
    assert len(got) == 16 * len(rows) and {r["n"] for r in got} == {n} == {400}
    assert Counter((r["vec_id"], int(r["deviation"])) for r in got) == Counter({(i, d): 16 * k for (i, d), k in Counter(
        (i, d) for (i, _), d in zip(rows, deviations)).items()})
    assert {r["identity_error"] for r in got} == {got[0]["identity_error"]} and got[0]["identity_error"] < 1e-10
    by = {(r["vec_id"], r["component"]): r for r in got}
    signs = {}
    for (i, _), row in zip(rows, whitened):
        for k in range(16):
            r = by[i, k + 1]
            assert r["explained"] == pytest.approx(values[k] / trace, rel=1e-9)
            sign = signs.setdefault(k, np.sign(r["whitened"] * row[k]))
            assert r["whitened"] == pytest.approx(sign * row[k], rel=1e-7, abs=1e-8)


def test_edges(spark, scratch):  # noqa: F811
    columns = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for rows in ([], [(1, None)], [(1, [])], [(1, [2.0, 3.0]), (2, [2.0, 3.0])]):
        out = w.whiten(frame(spark, rows), scratch)
        assert out.columns == columns and out.count() == 0
    # three points on a line have one component with variance
    line = w.whiten(frame(spark, [(1, [0.0, 0.0]), (2, [1.0, 1.0]), (3, [2.0, 2.0])]), scratch).collect()
    assert sorted(r["component"] for r in line) == [1, 1, 1] and line[0]["explained"] == pytest.approx(1)
    assert sorted(abs(r["whitened"]) for r in line) == pytest.approx([0, 1.5**0.5, 1.5**0.5])
    # far beyond 64 bits, still exact
    huge = w.whiten(frame(spark, [(1, [0.0]), (2, [2.0**45])]), scratch).collect()
    assert {int(r["deviation"]) for r in huge} == {(64 * 2**45) ** 2}


@pytest.mark.parametrize("size, values", [
    (64, np.linspace(1, 1.3, 64)), (120, np.r_[np.full(5, 9.0), np.full(20, 8.999), np.ones(95)]), (200, 0.97 ** np.arange(200)),
    (30, np.r_[np.arange(1, 6), np.zeros(25)]), (1, np.ones(1)), (5, np.arange(5.0))])
def test_eigenpairs_to_double_precision(size, values):
    basis = np.linalg.qr(np.random.default_rng(size).standard_normal((size, size)))[0]
    matrix = (basis * values) @ basis.T
    matrix = (matrix + matrix.T) / 2
    found, vectors = largest_eigenpairs(lambda x: matrix @ x, size, 16)
    want = np.sort(values)[::-1][:16]
    assert found == pytest.approx(want, abs=1e-13 * max(want))
    assert np.abs(matrix @ vectors - vectors * found).max() < 1e-13 * max(want)
    assert np.abs(vectors.T @ vectors - np.eye(len(found))).max() < 1e-13


def test_minres_solves_indefinite_systems_side_by_side():
    rnd = np.random.default_rng(1)
    basis = np.linalg.qr(rnd.standard_normal((20, 20)))[0]
    matrix = (basis * np.r_[-3:7:20j]) @ basis.T
    right = np.c_[rnd.standard_normal((20, 3)), np.zeros(20)]
    assert np.abs(matrix @ minres(lambda x: matrix @ x, right, 60, 1e-12) - right).max() < 1e-9
