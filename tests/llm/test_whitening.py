"""Whitening against covariances in fractions, and its defined cases."""

import math
from fractions import Fraction

import numpy as np
from pyspark.sql import functions as F

from eventjobs.llm import whitening

SCHEMA = "vec_id long, embedding array<float>"


def brute(vectors):
    """x, n, S, the covariance in fractions, and deviations."""
    x = [[math.floor(1024 * float(c)) + 100_000 for c in v] for v in vectors]
    n, dims = len(x), len(x[0])
    s = [sum(row[i] for row in x) for i in range(dims)]
    d = [[n * row[i] - s[i] for i in range(dims)] for row in x]
    v = [[Fraction(sum(r[i] * r[j] for r in d), n**3) for j in range(dims)] for i in range(dims)]
    return x, n, s, v, [sum(c * c for c in r) for r in d]


def test_covariance_by_squares_only_is_exact():
    rng = np.random.default_rng(1)
    x = rng.integers(99_000, 101_000, (70, 5))
    n, total = len(x), [int(t) for t in x.sum(axis=0)]
    centre = np.array([t // n for t in total])
    rest = [t - n * int(c) for t, c in zip(total, centre, strict=True)]
    products, v = whitening.covariance(n, rest, whitening.squares(x - centre))
    d = n * x - np.array(total)
    assert products == (d.T @ d).tolist()
    assert np.allclose(v, d.T @ d / n**3, rtol=1e-15)
    far = whitening.squares(np.array([[1 << 51, -(1 << 50)], [3, 4]]))  # squares beyond 63 bits
    assert far == [((1 << 51) + 3, (1 << 102) + 9), (4 - (1 << 50), (1 << 100) + 16), ((1 << 50) + 7, (1 << 100) + 49)]


def test_whitening(spark):
    rng = np.random.default_rng(2)
    data = (rng.normal(size=(300, 6)) @ np.diag([5, 3, 1, 0.5, 0.2, 0.1]) + rng.normal(size=6) * 40).astype(np.float32)
    bad = [(1000, None), (1001, [float("nan")] * 6), (1002, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (1003, [float("inf"), 0.0, 0.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame([*((k, [float(c) for c in v]) for k, v in enumerate(data)), *bad], SCHEMA).repartition(7).withColumns({"n": F.lit("clash"), "component": F.lit("clash")})
    got = whitening.whiten(df, 4).collect()
    x, n, s, v, deviations = brute(data.tolist())
    values, axes = np.linalg.eigh(np.array(v, dtype=float))
    assert len(got) == 4 * n and {r.n for r in got} == {n} and {r.vec_id for r in got} == set(range(n))
    assert all(int(r.deviation) == deviations[r.vec_id] for r in got)
    for c in range(4):
        own = {r.vec_id: r.whitened for r in got if r.component == c + 1}
        want = (np.array(x) - np.array(s) / n) @ axes[:, -1 - c] / np.sqrt(values[-1 - c])
        have = np.array([own[k] for k in range(n)])
        assert min(np.abs(have - want).max(), np.abs(have + want).max()) < 1e-9
        assert {round(r.explained, 12) for r in got if r.component == c + 1} == {round(float(values[-1 - c] / values.sum()), 12)}
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9


def test_defined_cases(spark):
    make = lambda rows: spark.createDataFrame(rows, SCHEMA)
    assert whitening.whiten(make([])).count() == 0 and whitening.whiten(make([(1, None), (2, [])])).count() == 0
    one = whitening.whiten(make([(7, [0.5, 0.25])])).collect()
    assert [(r.component, r.n, int(r.deviation), r.whitened, r.explained, r.identity_error) for r in one] == [(1, 1, 0, None, 0.0, None), (2, 1, 0, None, 0.0, None)]
    # Null and repeated ids are rows; a shorter vector's missing entries count as 0; the second component has no variance.
    few = whitening.whiten(make([(None, [1.0, 0.0]), (3, [-1.0]), (3, [-1.0, 0.0])])).collect()
    assert len(few) == 6 and [r.whitened for r in few if r.component == 2] == [None] * 3 and few[0].identity_error < 1e-12
    assert sorted(round(abs(r.whitened), 6) for r in few if r.component == 1) == [0.707107, 0.707107, 1.414214]
    far = whitening.whiten(make([(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [0.0, 5.0])])).collect()
    assert len(far) == 6 and all(r.deviation is not None for r in far)
    large = np.linspace(-1, 1, 3 * 70).reshape(70, 3)
    assert whitening.whiten(make([(k, [float(c) for c in v]) for k, v in enumerate(large)]).repartition(40)).count() == 210
