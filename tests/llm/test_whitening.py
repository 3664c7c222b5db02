"""Embedding whitening: against a dense eigen-decomposition, inertia against eigenvalues, exact integer columns."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from buyhorizon.llm import whitening as W


def symmetric(values, seed=0):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    return q @ np.diag(values) @ q.T


SPECTRA = {
    "spread": np.geomspace(1e-3, 1e3, 30),
    "flat": np.linspace(1, 1.01, 25),
    "ties": np.array([5.0] * 6 + [3.0] * 6 + [1.0] * 8),
    "near ties": 2 + np.arange(20) * 1e-9,
    "low rank": np.array([0.0] * 20 + [1.0, 2.0, 4.0]),
    "one": np.array([3.0]),
}


@pytest.mark.parametrize("name", SPECTRA)
def test_inertia_counts(name):
    values = SPECTRA[name]
    v = symmetric(values)
    for shift in [-1.0, *((values[:-1] + values[1:]) / 2), values.max() + 1]:
        if np.abs(values - shift).min() > 1e-11 * values.max():
            assert W.above(v, shift) == (values > shift).sum()


def test_inertia_of_zero_diagonals():
    assert W.above(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1 and W.above(np.zeros((3, 3)), 0.0) == 0


@pytest.mark.parametrize("name", SPECTRA)
def test_components_equal_a_dense_decomposition(spark, name):
    values = np.sort(SPECTRA[name])[::-1]
    v = symmetric(values)
    got, vectors = W.components(spark, v, 16)
    want = values[values > 0][:16]
    assert len(got) == len(want) and np.allclose(got, want, rtol=1e-11)
    assert np.abs(vectors.T @ vectors - np.eye(len(got))).max() < 1e-13
    assert np.abs(v @ vectors - vectors * got).max() < 1e-12 * values[0] * len(v)


def test_projector_filters_one_interval():
    values = np.geomspace(1e-3, 1e3, 40)
    got, vectors = W.feast(symmetric(values), 0.5, 3.0, int(((values > 0.5) & (values <= 3)).sum()))
    assert np.allclose(np.sort(got), values[(values > 0.5) & (values <= 3)]) and vectors.shape == (40, len(got))


def test_intervals_are_disjoint_and_counted():
    v = symmetric(np.geomspace(1e-3, 1e3, 40))
    found = W.intervals(v, 16)
    assert sum(c for _, _, c in found) >= 16 and all(c <= W.PER_INTERVAL for _, _, c in found)
    assert all(W.above(v, low) - W.above(v, high) == c for low, high, c in found)
    assert all(b[1] <= a[0] for a, b in zip(found, found[1:], strict=False))


def table(spark, vectors, extra=()):
    rows = [(i, None if v is None else [None if c is None else float(c) for c in v], "clash", 1.0) for i, v in enumerate([*vectors, *extra])]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, component string, whitened double")


def run(df, most=16):
    return W.whitened(df.select(F.col("vec_id").alias("id"), W.integers(F.col("embedding")).alias("x")), most)


def test_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    base = (rng.standard_normal((300, 20)) * np.geomspace(0.02, 3, 20) + 0.7).astype(np.float32)
    vectors = np.concatenate([base, base[:7].repeat(30, axis=0)])
    bad = [None, [], [1.0] * 19, [None] + [1.0] * 19, [math.nan] + [1.0] * 19, [math.inf] + [1.0] * 19]
    got = {(r.id, r.component): r for r in run(table(spark, vectors, bad).repartition(5)).collect()}
    assert len(got) == 16 * len(vectors) and max(i for i, _ in got) == len(vectors) - 1
    x = np.floor(vectors.astype(np.float64) * 64).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    y = fit - sums / n
    v = y.T @ y / n
    values, dense = np.linalg.eigh(v)
    for k in range(1, 17):
        e, u = values[-k], dense[:, -k]
        want = (x - sums / n) @ u / math.sqrt(e)
        mine = np.array([got[i, k].whitened for i in range(len(x))])
        assert min(np.abs(mine - want).max(), np.abs(mine + want).max()) < 1e-8
        assert abs(got[0, k].explained - e / np.trace(v)) < 1e-10
    for i in (0, 5, 400):
        r = got[i, 1]
        assert r.n == n and r.deviation == sum((n * int(a) - int(s)) ** 2 for a, s in zip(x[i], sums, strict=True)) and r.identity_error < 1e-9
    assert len({r.identity_error for r in got.values()}) == 1


def test_few_vectors_and_empty(spark):
    assert run(table(spark, [])).count() == 0
    assert run(table(spark, [None, []])).count() == 0
    assert run(table(spark, [[1.0, 2.0]] * 5)).count() == 0  # one distinct vector varies nowhere
    got = run(table(spark, [[0.0, 2.0], [1.0, 2.0], [1.0, 2.0]])).orderBy("id").collect()
    assert [(r.id, r.component, r.n, r.deviation) for r in got] == [(0, 1, 2, 4096), (1, 1, 2, 4096), (2, 1, 2, 4096)]
    assert all(abs(abs(r.whitened) - 1) < 1e-12 and abs(r.explained - 1) < 1e-12 for r in got)


def test_sums_beyond_a_double(spark):
    """Large entries: integer sums stay exact."""
    rows = [(i, [4e9 + 64 * i, -3e9 + 128 * i]) for i in range(50)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    x = df.select(W.integers(F.col("embedding")).alias("x"))
    found = W.moments(x, 2)
    want = [[int(math.floor(64 * c)) + 1_000_000 for c in v] for _, v in rows]
    assert found.n == 50 and found.sums == [sum(c) for c in zip(*want, strict=True)]
    y = np.array([[a * 50 - s for a, s in zip(r, found.sums, strict=True)] for r in want], float) / 50
    assert np.allclose(found.covariance, y.T @ y / 50, rtol=1e-12)
