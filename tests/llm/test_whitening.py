"""Jacobi-Davidson whitening against a dense eigensolver."""

import math

import numpy as np
import pytest

from tidemark.llm import whitening


def dense(x):
    """Sizes, eigenvalues and vectors of the covariance of the distinct rows of x."""
    distinct = np.unique(x, axis=0)
    centred = distinct - distinct.mean(axis=0)
    values, vectors = np.linalg.eigh(centred.T @ centred / len(distinct))
    return distinct, values[::-1], vectors[:, ::-1]


@pytest.mark.parametrize("dim, kind", [(3, "flat"), (64, "flat"), (200, "flat"), (200, "falling"), (64, "flat rank"), (20, "equal")])
def test_solver(dim, kind):
    rng, count = np.random.default_rng(dim), min(16, dim)
    x = rng.standard_normal((3000, dim))
    x = x / np.arange(1, dim + 1) if kind == "falling" else x[:, :5] @ x[:5] if kind == "flat rank" else x
    matrix = np.eye(dim) if kind == "equal" else x.T @ x / len(x)
    widths = []

    def product(w):
        widths.append(w.shape[1])
        return matrix @ w

    values, vectors = whitening.jacobi_davidson(product, dim, count)
    want = np.linalg.eigvalsh(matrix)[::-1][:count]
    assert np.abs(values - want).max() < 1e-13 * want[0]
    assert np.linalg.norm(matrix @ vectors - vectors * values, axis=0).max() < 1e-13 * want[0]
    assert np.abs(vectors.T @ vectors - np.eye(count)).max() < 1e-13
    assert max(widths) <= count + 4  # never the whole matrix at once


def test_minres_solves():
    rng = np.random.default_rng(3)
    a = rng.standard_normal((12, 12))
    a, b = a + a.T, rng.standard_normal((12, 4))
    assert np.abs(a @ whitening._minres(lambda w: a @ w, b, 12) - b).max() < 1e-8


def test_every_row_and_component(spark):
    rng = np.random.default_rng(1)
    vectors = (rng.standard_normal((300, 6)) @ np.diag([5, 3, 2, 1, 0.5, 0.2])).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)] + [(1000 + i, vectors[0].tolist()) for i in range(200)]
    odd = [None, [], [1.0], [math.nan] * 6, [math.inf, 0.0, 0.0, 0.0, 0.0, 0.0], [None, 0.0, 0.0, 0.0, 0.0, 0.0], [1e300] * 6]
    rows += [(2000 + i, v) for i, v in enumerate(odd)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as n", "'x' as whitened")
    got = whitening.whiten(table, "vec_id", "embedding").toPandas()
    x = np.floor(64 * vectors.astype(float)) + 1000000
    distinct, values, axes = dense(x)
    n, sums = len(distinct), [sum(int(v) for v in c) for c in distinct.T]
    assert len(got) == 500 * 6 and set(got.n) == {n} and (got.vec_id < 2000).all()
    assert got.identity_error.max() < 1e-10
    for k in range(6):
        own = got[got.component == k + 1].set_index("vec_id").loc[range(300)]
        want = (x - distinct.mean(axis=0)) @ axes[:, k] / math.sqrt(values[k])
        assert min(np.abs(own.whitened - want).max(), np.abs(own.whitened + want).max()) < 1e-9
        assert np.allclose(own.explained, values[k] / values.sum(), rtol=1e-12)
        assert own.deviation.tolist() == [sum((n * int(a) - s) ** 2 for a, s in zip(r, sums, strict=True)) for r in x]
    copies = got[(got.vec_id >= 1000) & (got.component == 1)]
    assert len(copies) == 200 and copies.whitened.nunique() == 1


def test_odd_tables(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        assert whitening.whiten(spark.createDataFrame(rows, schema), "vec_id", "embedding").count() == 0
    # no variance in the second direction: one component; equally frequent lengths: the shorter
    rows = [(1, [0.0, 1.0]), (2, [2.0, 1.0]), (3, [4.0, 1.0]), (4, [1.0] * 3), (5, [2.0] * 3), (6, [3.0] * 3), (None, [2.0, 1.0])]
    got = whitening.whiten(spark.createDataFrame(rows, schema), "vec_id", "embedding").toPandas()
    assert got.component.tolist() == [1] * 4 and set(got.n) == {3} and np.allclose(got.explained, 1)
    assert np.allclose(sorted(np.abs(got.whitened)), [0, 0, math.sqrt(1.5), math.sqrt(1.5)])
    # far beyond 64 bits: exact or null
    rows = [(1, [2.0**44, 0.0]), (2, [-(2.0**44), 1.0]), (3, [0.0, 0.0])]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding").toPandas()
    assert set(got.component) == {1}  # the other direction has next to no variance
    assert got.deviation.isna().tolist() == [True, True, False]
