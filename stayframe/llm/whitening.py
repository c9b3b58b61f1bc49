"""Whitening of embeddings from the exact characteristic polynomial of their scatter.

Entries become integers (256 times the entry, rounded down), so the scatter
matrix M = n * sum(x x') - S S' of the distinct vectors is an exact integer
matrix (n^2 times their covariance). Its characteristic polynomial comes from
Hessenberg reductions modulo as many primes as its coefficients need, dealt
out to tasks, and Chinese remaindering. All its roots are real, so by
Descartes' rule the sign changes of the polynomial shifted to any point count
the roots above it exactly, with multiplicity; bisection on that count gives
each root to ``BITS`` bits. Components are null vectors of M - root, found by
inverse iteration in ``DIGITS`` decimal digits and made orthogonal to those
before, also where roots coincide.

Spark does what grows with the table: the distinct vectors, the scatter (exact
sums of bounded blocks), the whitened rows and the check of their covariance.
The driver holds matrices of the embedding's dimension only.

Vectors that are null or hold null or non-finite entries take no part. If
vectors differ in length, those of the commonest length (of equals the longest)
take part. A null vec_id stays null; repeated rows are repeated in the result
and count once in the fit. Components without variance are left out, so an
empty table, one vector or copies of one give no rows. Extra columns are
ignored. ``deviation`` is a decimal(38, 0).
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from decimal import Decimal, localcontext
from functools import partial

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayframe.llm.common import cut

SCALE, COMPONENTS, BITS, DIGITS, LIMB, ROWS, PRIMES_A_TASK = 256, 4, 160, 100, 20, 4096, 16


# Exact characteristic polynomial ---------------------------------------------


def primes_below(limit: int, count: int) -> list[int]:
    """The ``count`` greatest primes below ``limit`` (at most 2^31), greatest first."""
    root = math.isqrt(limit) + 1
    sieve = np.ones(root + 1, bool)
    sieve[:2] = False
    for k in range(2, math.isqrt(root) + 1):
        sieve[k * k :: k] = False
    small, found, high = np.flatnonzero(sieve), [], limit
    while len(found) < count and high > root:
        low = max(root, high - (1 << 16))
        stretch = np.ones(high - low, bool)
        for p in small.tolist():
            stretch[-low % p :: p] = False
        found += (low + np.flatnonzero(stretch))[::-1].tolist()
        high = low
    return found[:count]


def _power(base: np.ndarray, exponent: np.ndarray, p: np.ndarray) -> np.ndarray:
    out, base, exponent = np.ones_like(base), base.copy(), exponent.copy()
    while exponent.any():
        out = np.where(exponent & 1, out * base % p, out)
        base, exponent = base * base % p, exponent >> 1
    return out


def polynomials_mod(matrix: list[list[int]], primes: list[int]) -> np.ndarray:
    """Coefficients (constant first) of the characteristic polynomial modulo each prime, by Hessenberg reduction."""
    d, many = len(matrix), np.arange(len(primes))
    whole = np.array(matrix, object).reshape(d, d)
    h = np.stack([(whole % p).astype(np.int64) for p in primes])
    p1 = np.array(primes, np.int64)
    p2, p3 = p1[:, None], p1[:, None, None]
    for k in range(1, d - 1):
        pivot = k + np.argmax(h[:, k:, k - 1] != 0, axis=1)
        for view in (h, h.transpose(0, 2, 1)):  # swap rows k and pivot, then columns
            row = view[many, pivot].copy()
            view[many, pivot], view[many, k] = view[:, k].copy(), row
        inverse = _power(h[:, k, k - 1], p1 - 2, p1)  # 0 where the column is empty: nothing to clear there
        times = h[:, k + 1 :, k - 1] * inverse[:, None] % p2
        h[:, k + 1 :] = (h[:, k + 1 :] - times[:, :, None] * h[:, None, k] % p3) % p3
        h[:, :, k] = (h[:, :, k] + (h[:, :, k + 1 :] * times[:, None, :] % p3).sum(2)) % p2
    poly = np.zeros((d + 1, len(primes), d + 1), np.int64)
    poly[0, :, 0] = 1
    for k in range(1, d + 1):
        now = -h[:, k - 1, k - 1, None] * poly[k - 1] % p2
        now[:, 1:] += poly[k - 1, :, :-1]
        down = np.ones(len(primes), np.int64)  # product of the entries below the diagonal
        for i in range(k - 2, -1, -1):
            down = down * h[:, i + 1, i] % p1
            now -= (h[:, i, k - 1] * down % p1)[:, None] * poly[i] % p2
        poly[k] = now % p2
    return poly[d]


def _residues(batches, matrix, primes):
    import pyarrow as pa

    for b in batches:
        for k in b.column(0).to_pylist():
            part = primes[k * PRIMES_A_TASK : (k + 1) * PRIMES_A_TASK]
            found = polynomials_mod(matrix.value, part).tolist()
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(found, pa.list_(pa.int64()))], ["prime", "coefficients"])


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Integer coefficients, constant first, of a symmetric positive semi-definite integer matrix."""
    d, trace = len(matrix), sum(matrix[k][k] for k in range(len(matrix)))
    # the k-th coefficient is at most C(d, k) (trace / d)^k in size; two bits for the sign and rounding
    bits = max(math.log2(math.comb(d, k)) + k * (math.log2(max(trace, 1)) - math.log2(max(d, 1))) for k in range(d + 1)) + 2
    primes = primes_below(1 << 31, max(1, math.ceil(bits / 30.9)))
    tasks = -(-len(primes) // PRIMES_A_TASK)
    rows = spark.range(0, tasks, 1, tasks).mapInArrow(partial(_residues, matrix=spark.sparkContext.broadcast(matrix), primes=primes), "prime long, coefficients array<long>")
    modulus, total = math.prod(primes), [0] * (d + 1)
    for r in rows.collect():  # d + 1 numbers for each prime
        rest = modulus // r.prime
        lift = rest * pow(rest, -1, r.prime)
        total = [t + c * lift for t, c in zip(total, r.coefficients)]
    return [c - modulus if 2 * (c := t % modulus) > modulus else c for t in total]


# Roots and components --------------------------------------------------------


def roots_above(poly: list[int], at: int, shift: int = 0) -> int:
    """How many roots of a polynomial with real roots only exceed at / 2^shift."""
    d = len(poly) - 1
    c = [x << shift * (d - k) if shift >= 0 else x << -shift * k for k, x in enumerate(poly)]  # its roots are 2^shift times as large
    for k in range(d):
        for j in range(d - 1, k - 1, -1):
            c[j] += at * c[j + 1]
    signs = [x > 0 for x in c if x]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def greatest_roots(poly: list[int], count: int, bits: int = BITS) -> list[tuple[int, int]]:
    """(u, s) with u / 2^s within one unit of u above each of the greatest positive roots, greatest first, ``bits`` bits each."""
    d = len(poly) - 1
    positive = d - next(k for k, x in enumerate(poly) if x)
    top = max(abs(poly[d - 1]) if d else 0, 1).bit_length()  # of the trace
    out = []
    for k in range(1, min(count, positive) + 1):
        low, high = -top * d - 1, top + 1  # the root lies above 2^low and not above 2^high
        while high - low > 1:
            mid = (low + high) // 2
            if roots_above(poly, 1 << max(mid, 0), max(-mid, 0)) >= k:
                low = mid
            else:
                high = mid
        s = bits - high
        a, b = 1 << (bits - 1), 1 << bits
        while b - a > 1:
            mid = (a + b) // 2
            if roots_above(poly, mid, s) >= k:
                a = mid
            else:
                b = mid
        out.append((b, s))
    return out


def null_vectors(matrix: list[list[int]], roots: list[tuple[int, int]]) -> list[list[Decimal]]:
    """An orthonormal vector for each root, by inverse iteration."""
    d, out = len(matrix), []
    with localcontext() as ctx:
        ctx.prec, ctx.Emax, ctx.Emin = DIGITS, 10**9, -(10**9)
        whole = np.array([[Decimal(x) for x in row] for row in matrix], object).reshape(d, d)
        tiny = max(abs(x) for x in whole.ravel()) * Decimal(10) ** (10 - DIGITS)
        for number, (u, s) in enumerate(roots):
            a = whole.copy()
            a[np.arange(d), np.arange(d)] -= Decimal(u) / Decimal(2) ** s
            order = list(range(d))
            for k in range(d):  # rows exchanged for the greatest pivot, factors kept below the diagonal
                best = max(range(k, d), key=lambda i: abs(a[i, k]))
                a[[k, best]], order[k], order[best] = a[[best, k]], order[best], order[k]
                if abs(a[k, k]) < tiny:
                    a[k, k] = tiny
                a[k + 1 :, k] /= a[k, k]
                a[k + 1 :, k + 1 :] -= np.outer(a[k + 1 :, k], a[k, k + 1 :])
            v = np.array([Decimal((7919 * (i + 1) * (number + 1)) % 1009 - 504) + Decimal("0.5") for i in range(d)], object)
            for _ in range(3):
                v = v[order]
                for k in range(d):
                    v[k + 1 :] -= a[k + 1 :, k] * v[k]
                for k in range(d - 1, -1, -1):
                    v[k] = (v[k] - (a[k, k + 1 :] * v[k + 1 :]).sum()) / a[k, k]
                v /= max(abs(x) for x in v)
                for _again in range(2):
                    for w in out:
                        v = v - (v * w).sum() * w
                v = v / (v * v).sum().sqrt()
            lead = max(range(d), key=lambda i: (abs(v[i]), -i))
            out.append(v if v[lead] > 0 else -v)
        return [list(v) for v in out]


# Spark -----------------------------------------------------------------------


@dataclass(frozen=True)
class Whitening:
    """n distinct vectors with sums ``total``; per component its axis, deviation (root of the eigenvalue) and share of the variance."""

    n: int
    total: list[int]
    axes: np.ndarray
    spread: list[float]
    explained: list[float]


def integer_vectors(embeddings: DataFrame, column: str = "embedding") -> DataFrame:
    """vec_id, x (array of long) of the vectors that take part."""
    c = F.col("v")
    finite = F.forall(c, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("v")).where(c.isNotNull() & finite)
    size = rows.groupBy(F.size("v").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    return rows.where(F.size("v") == (size.size if size else 0)).select("vec_id", F.transform("v", lambda e: F.floor(F.lit(float(SCALE)) * e)).alias("x"))


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if hasattr(column, "combine_chunks") else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _scatter(batches):
    """Exact sums of products of all pairs of entries, with a last entry of one in each vector."""
    import pyarrow as pa

    total = 0
    for b in batches:
        x = _matrix(b.column(0))
        for at in range(0, len(x), ROWS):
            part = np.hstack((x[at : at + ROWS], np.ones((len(x[at : at + ROWS]), 1), np.int64)))
            limbs = []  # signed pieces of LIMB bits: a block's sums of products stay below 2^53
            while part.any():
                low = part & ((1 << LIMB) - 1)
                limbs.append(low.astype(np.float64))
                part = (part - low) >> LIMB
                if (part < 0).any() and not (part + (part < 0)).any():
                    limbs.append(part.astype(np.float64))  # the signs alone are left
                    break
            for i, a in enumerate(limbs):
                for j, c in enumerate(limbs):
                    total = total + ((a.T @ c).astype(np.int64).astype(object) << LIMB * (i + j))
    if isinstance(total, np.ndarray):
        i, j = np.triu_indices(len(total))
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([Decimal(int(v)) for v in total[i, j]], pa.decimal128(38, 0))], ["i", "j", "v"])


def fit(distinct: DataFrame, components: int = COMPONENTS) -> Whitening:
    """Whitening fitted on distinct integer vectors (x)."""
    sums = distinct.select("x").mapInArrow(_scatter, "i int, j int, v decimal(38,0)").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()  # bounded by the dimension
    d = max((r.j for r in sums), default=0)
    q = np.zeros((d + 1, d + 1), object)
    for r in sums:
        q[r.i, r.j] = q[r.j, r.i] = int(r.v)
    n, total = int(q[d, d]), [int(v) for v in q[d, :d]]
    matrix = [[n * q[i, j] - total[i] * total[j] for j in range(d)] for i in range(d)]
    trace = sum(matrix[k][k] for k in range(d))
    if not trace:
        return Whitening(n, total, np.zeros((0, d)), [], [])
    poly = characteristic_polynomial(distinct.sparkSession, matrix)
    roots = greatest_roots(poly, components)
    with localcontext() as ctx:
        ctx.prec = DIGITS
        values = [Decimal(u) / Decimal(2) ** s for u, s in roots]
        spread = [float(v.sqrt() / n) for v in values]
        explained = [float(v / trace) for v in values]
    axes = np.array([[float(x) for x in v] for v in null_vectors(matrix, roots)])
    return Whitening(n, total, axes, spread, explained)


def _project(x: np.ndarray, model: Whitening) -> tuple[np.ndarray, np.ndarray]:
    """n * x - S, exact (in Python integers, if it passes 62 bits), and the whitened values."""
    most = model.n * int(max(x.max(initial=0), -x.min(initial=0))) + max(map(abs, model.total), default=0)
    centred = (x if most < 1 << 62 else x.astype(object)) * model.n - np.array(model.total, np.int64 if most < 1 << 62 else object)
    return centred, centred.astype(np.float64) @ (model.axes / (model.n * np.array(model.spread)[:, None])).T


def _moments(batches, model):
    import pyarrow as pa

    k = len(model.value.spread)
    total = np.zeros((k + 1, k + 1))
    for b in batches:
        w = np.hstack((_project(_matrix(b.column(0)), model.value)[1], np.ones((b.num_rows, 1))))
        total += w.T @ w
    i, j = np.indices(total.shape).reshape(2, -1)
    yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total.ravel())], ["i", "j", "v"])


def identity_error(distinct: DataFrame, model: Whitening) -> float:
    """Greatest entry in size of the whitened vectors' covariance less the identity."""
    k = len(model.spread)
    shared = distinct.sparkSession.sparkContext.broadcast(model)
    got = np.zeros((k + 1, k + 1))
    for r in distinct.select("x").mapInArrow(partial(_moments, model=shared), "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        got[r.i, r.j] = r.v
    n, mean = max(got[k, k], 1), got[k, :k] / max(got[k, k], 1)
    return float(np.abs(got[:k, :k] / n - np.outer(mean, mean) - np.eye(k)).max(initial=0))


def _whitened(batches, model):
    import pyarrow as pa

    model = model.value
    k = len(model.spread)
    for b in batches:
        centred, w = _project(_matrix(b.column("x")), model)
        most = int(np.abs(centred).max(initial=0))
        wide = most * most * max(1, centred.shape[1]) >= 1 << 62
        deviation = ((centred.astype(object) if wide else centred) ** 2).sum(1)
        row = np.repeat(np.arange(b.num_rows), k)
        cols = [
            b.column("vec_id").take(pa.array(row)),
            pa.array(np.tile(np.arange(1, k + 1), b.num_rows), pa.int32()),
            pa.array([Decimal(int(v)) for v in deviation], pa.decimal128(38, 0)).take(pa.array(row)),
            pa.array(w.ravel()),
            pa.array(np.tile(model.explained, b.num_rows)),
        ]
        yield pa.RecordBatch.from_arrays(cols, ["vec_id", "component", "deviation", "whitened", "explained"])


def whiten(embeddings: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of every vector that takes part and each component."""
    rows = integer_vectors(embeddings, column)
    distinct = cut(rows.select("x").distinct())
    model = fit(distinct, components)
    schema = "vec_id long, component int, deviation decimal(38,0), whitened double, explained double"
    if not model.spread:
        found = embeddings.sparkSession.createDataFrame([], schema)
    else:
        found = rows.mapInArrow(partial(_whitened, model=embeddings.sparkSession.sparkContext.broadcast(model)), schema)
    error = identity_error(distinct, model)
    return found.select("vec_id", "component", F.lit(model.n).cast("long").alias("n"), "deviation", "whitened", "explained", F.lit(error).alias("identity_error"))


def whitening_rows(embeddings: DataFrame) -> DataFrame:
    """Contract columns of ``op12_whitening``."""
    return whiten(embeddings).withColumn("deviation", F.col("deviation").cast("long"))
