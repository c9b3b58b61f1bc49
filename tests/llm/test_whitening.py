"""Whitening against exact fractions and numpy: polynomial, roots, components, ties, nulls and odd vectors."""

from __future__ import annotations

from decimal import Decimal
from fractions import Fraction

import numpy as np
import pytest

from stayframe.llm import whitening


def plain_polynomial(m):
    """Faddeev-LeVerrier in exact fractions."""
    d = len(m)
    a, b, c = np.array(m, object), np.zeros((d, d), object), [Fraction(1)]
    for k in range(1, d + 1):
        b = a @ b + c[-1] * np.eye(d, dtype=int).astype(object)
        c.append(-Fraction(sum((a @ b)[i, i] for i in range(d)), k))
    return [int(x) for x in c[::-1]]


@pytest.mark.parametrize("d,rank,top", [(1, 1, 9), (2, 2, 50), (5, 3, 1000), (9, 9, 10**12), (8, 4, 1), (6, 0, 5)])
def test_polynomial_is_exact(spark, d, rank, top):
    rng = np.random.default_rng(d)
    g = rng.integers(-top, top + 1, (rank, d)).astype(object)
    m = (g.T @ g).tolist() if rank else [[0] * d for _ in range(d)]
    assert whitening.characteristic_polynomial(spark, m) == plain_polynomial(m)


def test_roots_with_multiplicity():
    poly = [1]
    for root in (0, 0, 1, 3, 7, 7, 7):
        poly = [(poly[k - 1] if k else 0) - root * (poly[k] if k < len(poly) else 0) for k in range(len(poly) + 1)]
    assert [whitening.roots_above(poly, x) for x in (-1, 0, 1, 2, 6, 7)] == [7, 5, 4, 4, 3, 0]
    got = [u / 2**s if s < 1000 else 0 for u, s in whitening.greatest_roots(poly, 6, 60)]
    assert np.allclose(got, [7, 7, 7, 3, 1], rtol=1e-15)
    u, s = whitening.greatest_roots([1, -(10**9), 1], 2, 80)[1]  # roots near 1e-9 and 1e9
    assert abs(Fraction(u, 1 << s) * 10**9 - 1) < Fraction(1, 10**8)


def test_vectors_of_near_and_equal_roots():
    q, _ = np.linalg.qr(np.random.default_rng(3).standard_normal((6, 6)))
    m = np.rint(q * 10**8).astype(object)
    v = m.T @ np.diag([10**6, 10**6 - 1, 10**5, 10, 3, 1]).astype(object) @ m
    matrix = [[int(x) for x in row] for row in v]
    roots = whitening.greatest_roots(plain_polynomial(matrix), 4)
    found = whitening.null_vectors(matrix, roots)
    for (u, s), w in zip(roots, found):
        left = [sum(Decimal(a) * b for a, b in zip(row, w)) - Decimal(u) / Decimal(2) ** s * x for row, x in zip(matrix, w)]
        assert max(map(abs, left)) < Decimal(u) / Decimal(2) ** s * Decimal("1e-20")
    gram = np.array([[float(sum(a * b for a, b in zip(x, y))) for y in found] for x in found])
    assert np.abs(gram - np.eye(4)).max() < 1e-14
    same = whitening.null_vectors([[2, 0, 0], [0, 2, 0], [0, 0, 2]], whitening.greatest_roots([-8, 12, -6, 1], 3))
    gram = np.array([[float(sum(a * b for a, b in zip(x, y))) for y in same] for x in same])
    assert np.abs(gram - np.eye(3)).max() < 1e-14


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "c") for i, v in rows], "vec_id long, embedding array<float>, label int, x string")


def test_whitened_rows_match_numpy(spark):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((300, 12)) * np.linspace(2, 0.2, 12)
    rows = [(k, v.tolist()) for k, v in enumerate(base)]
    rows += [(1000 + k, rows[7][1]) for k in range(150)] + [(None, rows[3][1])]  # a hot vector
    odd = [(2000, None), (2001, [float("nan")] * 12), (2002, [None] + [0.0] * 11), (2003, [float("inf")] + [0.0] * 11), (2004, [1.0, 2.0]), (2005, [])]
    got = whitening.whitening_rows(vectors(spark, rows + odd).repartition(6)).collect()
    assert len(got) == 4 * len(rows)
    x = {i: np.floor(256 * np.array(v, np.float32).astype(float)).astype(int) for i, v in rows}
    fit = np.unique(np.stack(list(x.values())), axis=0)
    n, total = len(fit), fit.sum(0)
    cov = (fit - total / n).T @ (fit - total / n) / n
    e, axes = np.linalg.eigh(cov)
    e, axes = e[::-1], axes[:, ::-1]
    sign = {}
    for r in got:
        k = r.component - 1
        want = (x[r.vec_id] - total / n) @ axes[:, k] / np.sqrt(e[k])
        s = sign.setdefault(k, 1 if abs(want - r.whitened) < abs(want + r.whitened) else -1)
        assert abs(s * want - r.whitened) < 1e-9 and r.n == n
        assert r.deviation == int(((n * x[r.vec_id] - total) ** 2).sum()) and abs(r.explained / (e[k] / np.trace(cov)) - 1) < 1e-9
        assert r.identity_error < 1e-9


def test_flat_and_empty_tables(spark):
    assert whitening.whitening_rows(vectors(spark, [(1, [1.0, 2.0])] * 3)).count() == 0
    assert whitening.whitening_rows(vectors(spark, [(1, None)])).count() == 0
    assert whitening.whitening_rows(vectors(spark, [(1, [1.0])]).limit(0)).count() == 0
    line = whitening.whitening_rows(vectors(spark, [(k, [float(k), 2.0 * k, 5.0]) for k in range(9)])).collect()
    assert {r.component for r in line} == {1} and abs(line[0].explained - 1) < 1e-12


def test_scatter_of_large_entries_is_exact(spark):
    rng = np.random.default_rng(8)
    big = rng.integers(-(1 << 55), 1 << 55, (50, 3))
    rows = spark.createDataFrame([(v.tolist(),) for v in big] + [([-1, 0, 1],), ([0, 0, 0],)], "x array<long>").repartition(3)
    every = [*big.astype(object).tolist(), [-1, 0, 1], [0, 0, 0]]
    got = {(r.i, r.j): int(r.v) for r in rows.mapInArrow(whitening._scatter, "i int, j int, v decimal(38,0)").groupBy("i", "j").agg({"v": "sum"}).withColumnRenamed("sum(v)", "v").collect()}
    for i in range(4):
        for j in range(i, 4):
            assert got[i, j] == sum(([*v, 1])[i] * ([*v, 1])[j] for v in every)
