"""Factors, sparse changepoints and drawn intervals against definitions."""

import datetime

import numpy as np
from pyspark.sql import functions as F

from tidemark.operators import changepoints, factors, linear
from tidemark.operators.changepoints import CHANGES, SPAN

DAY = datetime.date(2020, 1, 1)


def table(spark, parts):
    rows = [(k, x.tolist(), float(y)) for k, (xs, ys) in parts.items() for x, y in zip(xs, ys, strict=True)]
    return spark.createDataFrame(rows, "ticker string, x array<double>, y double").repartition(5)


def as_matrix(row):
    k = round(len(row.r) ** 0.5)
    return np.array(row.r).reshape(k, k)


def test_factors_hold_the_cross_products(spark, monkeypatch):
    monkeypatch.setattr(factors, "HELD", 1)
    rng = np.random.default_rng(0)
    parts = {k: (rng.normal(size=(n, 3)), rng.normal(size=n)) for k, n in (("a", 500), ("b", 2), (None, 40))}
    odd = spark.createDataFrame([("a", [1.0, None, 2.0], 1.0), ("a", [1.0, 2.0, 3.0], None)], "ticker string, x array<double>, y double")
    got = {r.ticker: r for r in factors.factors(table(spark, parts).union(odd)).collect()}
    assert set(got) == set(parts)
    for k, (x, y) in parts.items():
        z, r = np.column_stack([x, y]), as_matrix(got[k])
        assert got[k].n == len(y) and np.allclose(r.T @ r, z.T @ z) and np.allclose(r, np.triu(r)) and (np.diag(r) >= 0).all()
    assert factors.factors(table(spark, {"a": parts["a"]}).where("false")).count() == 0


def test_update_equals_one_pass_and_sums(spark):
    rng = np.random.default_rng(1)
    parts = {k: (rng.normal(size=(300, 4)), rng.normal(size=300)) for k in "ab"}
    rows = table(spark, parts)
    half = rows.withColumn("h", F.xxhash64("y") % 2)
    updated = factors.update(factors.factors(half.where("h = 0")), half.where("h <> 0"))
    sums = {r.ticker: r for r in linear.solve(linear.gram(rows)).collect()}
    for r in factors.solve(updated).collect():
        assert r.n == 300 and np.allclose(r.beta, sums[r.ticker].beta, rtol=1e-9) and np.isclose(r.sigma, sums[r.ticker].sigma, rtol=1e-9)
    ridge = factors.solve(updated, [0.0, 1.0, 2.0, 3.0]).collect()
    for r in ridge:
        x, y = parts[r.ticker]
        assert np.allclose(r.beta, np.linalg.solve(x.T @ x + np.diag([0.0, 1, 2, 3]), x.T @ y))


def test_factors_stay_right_where_sums_lose_all_digits(spark):
    rng = np.random.default_rng(2)
    a = rng.normal(size=400)
    x = np.column_stack([a, a + 1e-9 * rng.normal(size=400)])
    y = x @ [3.0, -2.0]
    rows = table(spark, {"a": (x, y)})
    assert np.allclose(factors.solve(factors.factors(rows)).first().beta, [3, -2], atol=1e-5)
    assert not np.allclose(linear.solve(linear.gram(rows)).first().beta, [3, -2], atol=1e-2)


def conditions(g, b, l1, l2, beta):
    """How far the optimum's conditions are missed."""
    slope = b - g @ beta - l2 * beta
    off = np.where(beta == 0, np.maximum(np.abs(slope) - l1, 0), np.abs(slope - l1 * np.sign(beta)))
    return off.max()


def test_lasso_meets_its_conditions():
    rng = np.random.default_rng(3)
    for trial in range(30):
        t = np.linspace(0, 1, 200)
        x = np.column_stack([np.ones(200), t, *[np.maximum(t - SPAN * (k + 1) / 26, 0) for k in range(25)], rng.normal(size=(200, 4))])
        y = 1 + t - 3 * np.maximum(t - 0.4, 0) + rng.normal(0, 0.05, 200)
        l1 = np.where((np.arange(31) >= 2) & (np.arange(31) < 27), 10.0 ** -(trial % 4), 0.0)
        l2 = np.where(l1 == 0, 1e-4, 0.0)
        g, b = x.T @ x, x.T @ y
        beta = changepoints.lasso(g, b, l1, l2)
        assert conditions(g, b, l1, l2, beta) < 1e-6 * np.abs(b).max()
    # a column that is nothing but others, and no column at all
    z = np.column_stack([np.ones(9), np.arange(9.0), np.arange(9.0)])
    beta = changepoints.lasso(z.T @ z, z.T @ np.arange(9.0), np.array([0, 0, 1.0]), np.zeros(3))
    assert np.allclose(z @ beta, np.arange(9.0))


def series(spark, closes, ticker="A"):
    rows = [(ticker, DAY + datetime.timedelta(i), float(c)) for i, c in enumerate(closes)]
    return spark.createDataFrame(rows, "ticker string, ds date, close double")


def test_few_changepoints_are_found(spark):
    n = 800
    t = np.arange(n) / (n - 1)
    place = SPAN * 13 / (CHANGES + 1)  # one of the hinges
    noise = np.random.default_rng(4).normal(0, 0.2, n)
    df = series(spark, 50 + 40 * t - 70 * np.maximum(t - place, 0) + noise).union(series(spark, np.full(120, 7.0), "flat"))
    span = df.groupBy("ticker").agg(F.min("ds").alias("first"), F.max("ds").alias("last"))
    found = {r.ticker: r for r in changepoints.fit(changepoints.design(df.withColumnRenamed("close", "y"), span)).collect()}
    hinges = np.array(found["A"].beta[2 : 2 + CHANGES])
    assert (hinges == 0).sum() > CHANGES / 2 and np.isclose(hinges[11:14].sum(), -70, rtol=0.1) and abs(found["A"].sigma / 0.2 - 1) < 0.15
    assert not np.any(found["flat"].beta[2 : 2 + CHANGES]) and found["flat"].jump == 0 and found["flat"].sigma < 1e-3


def test_intervals_widen_with_drawn_changes(spark):
    t = np.linspace(1.05, 2, 6)
    off = changepoints.futures(t, 0.1, 0.5, 7, draws=4000)
    width = np.subtract(*np.quantile(off, [0.975, 0.025], axis=0))
    assert (np.diff(width) > 0).all() and abs(np.median(off)) < 0.05
    # variance of a sum of a Poisson number of changes: rate * E[size^2] * integral of (t - s)^2
    assert np.allclose(off.var(axis=0), 0.01 + CHANGES * 2 * 0.25 * (t - 1) ** 3 / 3, rtol=0.25)
    still = changepoints.futures(t, 0.1, 0.0, 7, draws=4000)
    assert np.allclose(np.subtract(*np.quantile(still, [0.975, 0.025], axis=0)), 2 * linear.Z95 * 0.1, rtol=0.1)
    df = series(spark, 50 + np.cumsum(np.random.default_rng(5).normal(0, 1, 400)))
    got = changepoints.predict(df, linear.next_days(df, 30)).orderBy("ds").toPandas()
    again = changepoints.predict(df.repartition(3), linear.next_days(df, 30)).orderBy("ds").toPandas()
    assert len(got) == 30 and (got.lower < got.predicted).all() and (got.predicted < got.upper).all() and np.allclose(got[["lower", "upper"]], again[["lower", "upper"]])
    assert (got.upper - got.lower).iloc[-1] > (got.upper - got.lower).iloc[0]
