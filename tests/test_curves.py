"""Curves by blocks against plain running products, for short and long series."""

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import strategy

DAY = datetime.date(2000, 1, 1)


@pytest.mark.parametrize("block", [1, 7, 4096])
def test_blocks_change_nothing(spark, monkeypatch, block):
    monkeypatch.setattr(strategy, "BLOCK", block)
    rng, rows = np.random.default_rng(0), []
    for ticker, n in (("A", 200), ("B", 1), (None, 33)):
        close = 100 * np.exp(np.cumsum(rng.normal(0, 0.02, n + 1)))
        predicted = close[:-1] * (1 + rng.normal(0, 0.01, n))
        rows += [(ticker, "m", DAY + datetime.timedelta(11 * i), float(close[i]) if i != 5 else None, float(close[i + 1]), float(predicted[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "ticker string, model string, ds date, previous double, actual double, predicted double").repartition(3)
    signals = {(r.ticker, r.ds): r for r in strategy.signals(df).collect()}
    curve = strategy.equity(strategy.signals(df))
    days = {(r.ticker, r.day): r for r in curve.collect()}
    falls = {r.ticker: r.max_drawdown for r in strategy.drawdowns(curve).collect()}
    assert len(days) == len(rows) + 3
    for ticker in ("A", "B", None):
        value = benchmark = 10_000.0
        before, peak, worst = 0, 10_000.0, 0.0
        for i, (_, _, day, previous, actual, predicted) in enumerate(r for r in rows if r[0] == ticker):
            signal = None if previous is None else int(predicted > previous)
            got = signals[ticker, day]
            entry = None if signal is None else int(signal == 1 and not before)
            assert got.signal == signal and (signal is None or got.entry == entry)
            if previous is not None:
                move = (actual - previous) / previous
                value *= 1 + signal * move - entry * 0.001
                benchmark *= 1 + move
            before = signal
            row = days[ticker, i + 1]
            assert row.ds == day and np.isclose(row.value, value) and np.isclose(row.benchmark, benchmark)
            peak = max(peak, value)
            worst = min(worst, (value - peak) / peak)
        assert np.isclose(falls[ticker], worst)


def test_a_series_of_a_million_rows_is_many_tasks(spark):
    n = 1_000_000
    move = F.when(F.col("id") % 2 == 0, 0.0002).otherwise(-0.0001) - F.when(F.col("id") > 900_000, 0.0001).otherwise(0.0)
    df = spark.range(n).select(
        F.lit("A").alias("ticker"), F.lit("m").alias("model"), F.timestamp_seconds(F.col("id") * 1000).alias("ds"), move.alias("strategy_return"), move.alias("day_return")
    )
    got = strategy.equity(df, time="ds")
    i = np.arange(n)
    want = 10_000 * np.cumprod(1 + np.where(i % 2 == 0, 0.0002, -0.0001) - np.where(i > 900_000, 0.0001, 0.0))
    some = {r.day: r.value for r in got.where("day % 99991 = 1 or day = 1000000").collect()}
    assert len(some) >= 11 and all(np.isclose(v, want[d - 1], rtol=1e-9) for d, v in some.items())
    peak = np.maximum.accumulate(want)
    assert np.isclose(strategy.drawdowns(got).first().max_drawdown, ((want - peak) / peak).min(), rtol=1e-9)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small rows would be put together
    try:
        busiest = got.withColumn("task", F.spark_partition_id()).groupBy("task").count().agg(F.max("count")).first()[0]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert busiest < 0.5 * n


def test_numbers_from_the_end(spark):
    from tidemark.functions.long_series import from_end

    rows = [("A", t, float(t or 0)) for t in [*range(100), None]] + [("B", 5, 1.0), ("B", 5, 2.0), ("B", 4, 3.0), (None, 9, 4.0)]
    found = from_end(spark.createDataFrame(rows, "ticker string, ds int, close double"), 3, time="ds").collect()
    assert {(r.ticker, r.ds): r._back for r in found if r._back} == {("A", 99): 1, ("A", 98): 2, ("A", 97): 3, ("B", 5): 1, ("B", 4): 3, (None, 9): 1} and len(found) == len(rows)
