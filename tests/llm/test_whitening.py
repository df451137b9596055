"""Whitening against exact integers and the library's symmetric eigenvalues."""

import math

import numpy as np
import pytest

from tempoflow.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<double>, label int, x string, component int, whitened string"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, 1, "x", 7, "w") for i, v in vectors], SCHEMA)


def vectors():
    rng = np.random.default_rng(3)
    base = rng.normal(size=(300, 24)) @ rng.normal(size=(24, 24)) * np.linspace(0.1, 3, 24)
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(1000 + i, rows[5][1]) for i in range(200)]  # copies weigh nothing
    rows += [(None, rows[6][1]), (7, rows[7][1]), (7, rows[7][1]), (2000, [0.0] * 24)]
    rows += [(2001, None), (2002, []), (2003, [1.0] * 3), (2004, [math.nan] + [1.0] * 23), (2005, [None] + [1.0] * 23), (2006, [math.inf] + [1.0] * 23)]
    return rows


def usable(rows, d=24):
    return [(i, v) for i, v in rows if v is not None and len(v) == d and all(c is not None and math.isfinite(c) for c in v)]


def expected(rows, d=24):
    grid = [(i, tuple(math.floor(64 * c) + 1_000_000 for c in v)) for i, v in usable(rows, d)]
    fit = sorted({x for _, x in grid})
    sums = [sum(column) for column in zip(*fit, strict=True)]
    z = np.array([[(len(fit) * a - s) / len(fit) for a, s in zip(x, sums, strict=True)] for x in fit])
    values, components = np.linalg.eigh(z.T @ z / len(fit))
    return grid, fit, sums, values[::-1], components[:, ::-1]


def test_cholesky_and_jacobi():
    rng = np.random.default_rng(1)
    for d, rank in [(1, 1), (2, 1), (5, 5), (12, 4), (33, 33), (64, 60)]:
        half = rng.normal(size=(d, rank)) * np.logspace(0, 3, rank)
        v = half @ half.T
        l, order = whitening.pivoted_cholesky(v)
        assert l.shape[1] == rank and np.allclose(np.triu(l, 1), 0)
        assert np.allclose(l @ l.T, v[np.ix_(order, order)], rtol=1e-12, atol=1e-9 * v.max())
        values, vectors = whitening.one_sided_jacobi(l)
        assert np.allclose(values, np.linalg.eigvalsh(v)[::-1][:rank], rtol=1e-10, atol=1e-9 * v.max())
        assert np.abs(vectors.T @ vectors - np.eye(rank)).max() < 1e-13
    assert whitening.pivoted_cholesky(np.zeros((3, 3)))[0].shape == (3, 0)


def test_small_eigenvalues_keep_their_digits():
    """One-sided rotation of the factor resolves values that a two-sided one loses in rounding."""
    l = np.tril(np.random.default_rng(2).normal(size=(6, 6))) @ np.diag([1e6, 1e4, 1e2, 1, 1e-2, 1e-4])
    values, _ = whitening.one_sided_jacobi(l)
    assert np.allclose(values, np.linalg.svd(l)[1] ** 2, rtol=1e-9)


def test_all_pairs_meet_once_a_sweep():
    for n in range(1, 12):
        met = [tuple(sorted(p)) for a, b in whitening._rounds(n) for p in zip(a.tolist(), b.tolist(), strict=True)]
        assert sorted(met) == [(i, j) for i in range(n) for j in range(i + 1, n)]


def test_query_against_exact_sums_and_eigenvalues(spark, monkeypatch):
    rows = vectors()
    monkeypatch.setattr(queries, "read", lambda s, d, n: table(spark, rows).repartition(7))
    got = queries.op12_embedding_whitening(spark, "").collect()
    grid, fit, sums, values, components = expected(rows)
    n = len(fit)
    assert len(got) == 16 * len(grid)
    counts = {i: sum(1 for j, _ in grid if j == i) for i, _ in grid}
    by_key = {}
    for r in got:
        by_key.setdefault((r["vec_id"], r["component"]), []).append(r)
    assert all(len(v) == counts[i] for (i, _), v in by_key.items())
    signs = {}
    for i, x in grid:
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
        z = np.array([(n * a - s) / n for a, s in zip(x, sums, strict=True)])
        for k in range(16):
            r = by_key[i, k + 1][0]
            assert (r["n"], r["deviation"]) == (n, deviation)
            assert r["explained"] == pytest.approx(values[k] / values.sum(), rel=1e-9)
            white = z @ components[:, k] / math.sqrt(values[k])
            signs.setdefault(k, math.copysign(1, white * r["whitened"]) if abs(white) > 1e-3 else None)
            if signs[k] is None:
                del signs[k]
            else:
                assert r["whitened"] == pytest.approx(signs[k] * white, abs=1e-7)
    assert 0 <= got[0]["identity_error"] < 1e-9 and len({r["identity_error"] for r in got}) == 1


def test_few_dimensions_copies_and_empty_tables(spark):
    few = whitening.whiten(table(spark, [(i, [float(i), 2.0 * i, 5.0]) for i in range(9)]))
    assert {r["component"] for r in few.collect()} == {1} and few.count() == 9
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(5)]):
        empty = whitening.whiten(table(spark, rows))
        assert empty.count() == 0 and empty.columns == few.columns


def test_huge_entries_have_a_result(spark):
    rows = [(0, [1e300, 1.0]), (1, [-1e300, 2.0]), (2, [0.5, 3.0])]
    got = whitening.whiten(table(spark, rows)).collect()
    assert len(got) == 3 and all(math.isfinite(r["whitened"]) for r in got)  # beside 2^40 the second dimension is rounding noise
    assert {r["deviation"] for r in got if r["vec_id"] == 0} == {None}
    assert whitening._squares(whitening._differences(np.array([[3, 4]]), 2, np.array([1, 1], object))) == [25 + 49]
    big = whitening._differences(np.array([[1 << 40, 0]]), 1 << 30, np.array([0, 0], object))
    assert big[0, 0] == 1 << 70 and whitening._squares(big) == [None]
