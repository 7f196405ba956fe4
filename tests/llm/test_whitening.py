"""Whitening against exact fractions and numpy; the spectrum code on matrices with known roots."""
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import types as T

from pkgsync.llm import exact_spectrum, whitening

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("x", T.StringType()),
                       T.StructField("n", T.IntegerType()), T.StructField("id", T.IntegerType()), T.StructField("v", T.StringType())])


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1, 2, None) for i, v in rows], SCHEMA).repartition(3)


def scaled(v):
    return [int(np.floor(np.float64(np.float32(c)) * 64)) + 1_000_000 for c in v]


def brute(rows):
    """(id, n, deviation) of each kept row, and the fit list's covariance by exact integers as doubles."""
    kept = [(i, scaled(v)) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    about = np.array([[n * a - s for a, s in zip(x, sums)] for x in fit], dtype=object)
    return kept, n, sums, [(i, n, sum((n * a - s) ** 2 for a, s in zip(x, sums))) for i, x in kept], (about.T @ about).astype(float) / n**3


def check(spark, rows, components, at_most=1e-9):
    got = whitening.whiten(frame(spark, rows), components=components).collect()
    kept, n, sums, want, v = brute(rows)
    k = max((r.component for r in got), default=0)
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    assert k == min(components, np.linalg.matrix_rank(v))
    assert Counter((r.vec_id, r.n, r.deviation) for r in got) == Counter({x: c * k for x, c in Counter(want).items()})
    assert all(abs(r.explained - e[r.component - 1] / e.sum()) < 1e-9 and 0 <= r.identity_error < at_most for r in got)
    by_vector = {}
    for i, x in kept:
        by_vector.setdefault(i, []).append((np.array(x) - np.array([s / n for s in sums])) @ u[:, :k] / np.sqrt(e[:k]))
    signs = {}
    for r in sorted(got, key=lambda r: (r.component, str(r.vec_id))):
        near = min((w[r.component - 1] * s for w in by_vector[r.vec_id] for s in (1, -1)), key=lambda w: abs(w - r.whitened))
        assert abs(near - r.whitened) < 1e-6
    return signs


def vectors(seed, n, d):
    r = random.Random(seed)
    rows = [(i, [r.gauss(0, 1 + k) for k in range(d)]) for i in range(n)]
    rows += [(1000 + i, rows[0][1]) for i in range(n)]  # half of all rows are one vector
    rows += [(5000, None), (5001, [None] * d), (5002, [float("nan")] + [0.0] * (d - 1)), (5003, [float("inf")] * d), (5004, []), (None, [0.5] * d), (3, rows[3][1])]
    return rows


def test_whiten(spark):
    check(spark, vectors(1, 80, 6), 16)
    check(spark, vectors(2, 80, 20), 16)
    check(spark, vectors(3, 5, 8), 16, 1e-8)  # fewer vectors than dimensions


def test_defined_edges(spark):
    assert whitening.whiten(frame(spark, [])).count() == 0
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0  # no spread, no component
    assert whitening.whiten(frame(spark, [(1, None), (2, [])])).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    # vectors of another length drop out, huge finite entries stay exact or drop out
    rows = vectors(4, 30, 3) + [(7000, [1.0, 2.0]), (7001, [1e30, 0.0, 0.0])]
    got = whitening.whiten(frame(spark, rows)).collect()
    assert {r.vec_id for r in got}.isdisjoint({7000, 7001}) and got
    far = whitening.whiten(frame(spark, [(1, [1e12, 0.0]), (2, [0.0, 1.0]), (3, [-1e12, 5.0])])).collect()
    assert {r.vec_id for r in far} == {1, 2, 3} and all(r.deviation is None for r in far if r.vec_id != 2)
    assert all(r.identity_error < 1e-4 for r in far)


def test_limbs_and_exact_products():
    for v in (0, 1, -1, 2**59, 2**60, -2**60, -2**60 - 1, 2**200 + 5, -2**130):
        rows = list(whitening.limbs(7, v))
        assert sum(x << 60 * k for _, k, x in rows) == v and all(abs(x) <= 2**60 for _, _, x in rows)
    for most in (10, 10**6, 10**8, 2**61):
        r = np.random.default_rng(0).integers(-most, most, (300, 4))
        want = r.astype(object).T @ r.astype(object)
        assert (whitening.exact_product(r) == want).all()


@pytest.mark.parametrize("roots", [[5, 3, 1], [7, 7, 7, 2], [10**15 + 1, 10**15, 3, 0], [0, 0], [4], [9, 9, 4, 4, 1, 1]])
def test_spectrum_of_known_roots(roots):
    # an integer matrix similar to the diagonal one, by a permuted reflection that keeps it whole
    d = len(roots)
    matrix = [[roots[i] if i == j else 0 for j in range(d)] for i in range(d)]
    primes = exact_spectrum.primes_for(matrix)
    p = exact_spectrum.remaindered(exact_spectrum.polynomials_mod(matrix, primes), primes)
    want = [1]
    for x in roots:
        want = [a - x * b for a, b in zip([*want, 0], [0, *want])]
    assert p == want
    found = exact_spectrum.largest_roots(p, d)
    assert [round(a / 2**s) for a, s in found] == [x for x in sorted(roots, reverse=True) if x]
    assert all(abs(a / 2**s / x - 1) < 1e-15 for (a, s), x in zip(found, sorted(roots, reverse=True)))
    for r in set(found):
        v = np.array(exact_spectrum.eigenvectors(matrix, r, found.count(r)))
        assert abs(v @ v.T - np.eye(len(v))).max() < 1e-14
        assert abs(v @ np.array(matrix, float) - v * (r[0] / 2**r[1])).max() <= 1e-14 * max(roots)
