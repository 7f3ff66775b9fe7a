"""Hand-worked series and definitions."""

import datetime
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions.recurrence import ewm
from tidemark.functions.series import business_days, long_enough
from tidemark.operators import anomalies, ensemble, forecasts, indicators, linear, sentiment, strategy
from tidemark.sources import keyed, landed

DAY = datetime.date(2024, 1, 1)


def bars(spark, closes, ticker="A"):
    rows = [(ticker, DAY + datetime.timedelta(i), float(c), float(c), float(c), float(c), 10 + i) for i, c in enumerate(closes)]
    return spark.createDataFrame(rows, "ticker string, ds date, open double, high double, low double, close double, volume long")


@pytest.mark.parametrize("block", [1, 2, 64, 10_000])
@pytest.mark.parametrize("alpha", [2 / 13, 1 / 14, 0.9])
def test_block_scan_is_the_fold(spark, block, alpha):
    values = np.random.default_rng(1).normal(100, 20, 300).tolist()
    df = bars(spark, values)
    df = df.withColumn("x", F.when(F.dayofyear("ds") + 366 * (F.year("ds") - 2024) > 7, F.col("close")))
    got = [r.m for r in ewm(df, {"m": ("x", alpha)}, time="ds", block=block).orderBy("ds").collect()]
    want, e = [None] * 7, None
    for v in values[7:]:
        e = v if e is None else alpha * v + (1 - alpha) * e
        want.append(e)
    assert got[:7] == want[:7] and np.allclose(got[7:], want[7:], rtol=1e-12)


def test_constant_series(spark):
    df = bars(spark, [100] * 40)
    assert anomalies.merged_flags(df, time="ds").count() == 0
    rows = indicators.indicators(df, time="ds").collect()
    assert len(rows) == 15 and all(r.rsi_14 == 100 and r.bb_upper == r.bb_lower == 100 and abs(r.macd) < 1e-9 for r in rows)


def test_rising_and_short_series(spark):
    df = bars(spark, range(100, 140)).union(bars(spark, range(25), "B"))
    rows = indicators.indicators(df, time="ds").collect()
    assert {r.ticker for r in rows} == {"A"} and all(r.rsi_14 == 100 for r in rows)
    assert all(r.macd_hist is None or abs(r.macd_hist - (r.macd - r.macd_signal)) < 1e-12 for r in rows)
    assert {r.ticker for r in long_enough(df, 26).select("ticker").distinct().collect()} == {"A"}


def test_one_spike_is_flagged_once(spark):
    df = bars(spark, [99, 101] * 20 + [120])
    rows = anomalies.merged_flags(df, time="ds").where(F.col("ds") == DAY + datetime.timedelta(40)).collect()
    z = anomalies.zscore_flags(df, time="ds").collect()
    assert [(r.flag, r.zscore) for r in rows] == [("HIGH", z[-1].zscore)]
    assert anomalies.iqr_flags(df, time="ds").where("flag = 'HIGH'").count() == 1
    frozen = anomalies.iqr_flags(df, time="ds", fit_until=F.lit(DAY + datetime.timedelta(39))).collect()
    assert len(frozen) == 1 and frozen[0].zscore > anomalies.iqr_flags(df, time="ds").collect()[0].zscore


def test_zero_closes_do_not_fail(spark):
    from tidemark.operators.features import price_features

    rows = price_features(bars(spark, [0, 0, 5, 0, 1] * 4)).collect()
    assert rows[1].return_1d is None and rows[2].return_1d is None and rows[3].return_1d == -1


def test_business_days(spark):
    got = spark.range(1).select(business_days(F.lit(datetime.date(2024, 1, 5)), 7).alias("d")).first().d
    assert got[0] == datetime.date(2024, 1, 8) and len(got) == 7 and all(d.weekday() < 5 for d in got)


def test_strategy(spark):
    closes, signals = [100, 110, 99, 99, 120, 130], [1, 1, 1, 0, 1]
    rows = [("A", "m", DAY + datetime.timedelta(i), float(a), float(b), a + (1.0 if s else -1.0)) for i, (a, b, s) in enumerate(zip(closes, closes[1:], signals))]
    rows += [("A", "flat", *r[2:5], r[3] - 1) for r in rows]
    df = spark.createDataFrame(rows, "ticker string, model string, ds date, previous double, actual double, predicted double")
    out = {r.model: r for r in strategy.metrics(df).collect()}
    value = 1.0
    for a, b, s, e in zip(closes, closes[1:], signals, [1, 0, 0, 0, 1]):
        value *= 1 + s * (b / a - 1) - e * 0.001
    assert out["m"].num_trades == 2 and math.isclose(out["m"].final_value, 10_000 * value) and out["m"].max_drawdown < 0
    flat = out["flat"]
    assert (flat.total_return, flat.sharpe_ratio, flat.win_rate, flat.num_trades, flat.max_drawdown) == (0, 0, 0, 0, 0)
    curve = strategy.equity(strategy.signals(df))
    assert math.isclose(curve.where("model = 'm' and day = 5").first().value, out["m"].final_value)
    back = strategy.series_rows(strategy.series_json(curve)).where("model = 'm'").orderBy("day").collect()
    assert [r.day for r in back] == list(range(6)) and back[0].value == 10_000


def test_keyed_writes_are_idempotent(spark):
    old = spark.createDataFrame([("a", 1, 1.0), ("b", 1, 2.0), (None, 1, 9.0)], "k string, t int, v double")
    new = spark.createDataFrame([("b", 1, 7.0), ("c", 1, 3.0), ("c", 1, 4.0), (None, 1, 8.0)], "k string, t int, v double")
    same = lambda a, b: sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    keys = ["k", "t"]
    for write in (
        lambda t: keyed.insert_first(t, new, keys, ["v"]),
        lambda t: keyed.upsert_last(t, new, keys, [F.col("v").desc()]),
        lambda t: keyed.delete_keys(t, new, keys),
        lambda t: keyed.replace_keys(t, new, keys),
        lambda t: keyed.append_run(t, new.drop("run_at"), "2024-01-02") if "run_at" in t.columns else t,
    ):
        once = write(old)
        assert same(once, write(once))
    first = {(r.k, r.v) for r in keyed.insert_first(old, new, keys, ["v"]).collect()}
    last = {(r.k, r.v) for r in keyed.upsert_last(old, new, keys, [F.col("v").desc()]).collect()}
    assert first == {("a", 1.0), ("b", 2.0), ("c", 3.0), (None, 9.0)} and last == {("a", 1.0), ("b", 7.0), ("c", 4.0), (None, 8.0)}
    assert keyed.new_rows(old, new, keys, ["v"]).count() == 1


def test_stored_table_replaces_touched_partitions_only(spark, tmp_path):
    path = str(tmp_path / "t")
    keyed.save(spark.createDataFrame([(1, "a"), (2, "b")], "p int, v string"), path, ["p"])
    keyed.save(spark.createDataFrame([(2, "c")], "p int, v string"), path, ["p"], ["v"])
    assert {(r.p, r.v) for r in spark.read.parquet(path).collect()} == {(1, "a"), (2, "c")}


def test_landed_payloads(spark):
    good = '{"Time Series (15min)": {"2024-07-01 09:30:00": {"1. open":"1.0","2. high":"2","3. low":"0.5","4. close":"1.5","5. volume":"10"}, "2024-07-01 09:45:00": {"1. open":"x","4. close":null}}}'
    df = spark.createDataFrame([("A", good), ("B", '{"Note": "slow down"}'), ("C", '{"Information": "no"}'), ("D", "broken"), ("E", None)], "ticker string, payload string")
    rows, rejects = landed.series_bars(df, "Time Series (15min)", "US/Eastern", "15m", "feed")
    got = rows.collect()
    assert [(r.ticker, str(r.ts), r.close, r.volume) for r in got] == [("A", "2024-07-01 13:30:00", 1.5, 10)]
    assert {(r.ticker, r.reason) for r in rejects.collect()} == {("B", "slow down"), ("C", "no"), ("D", "no series"), ("E", "no series")}
    wide = spark.createDataFrame([("2024-01-02", 1.0, 2.0, 0.5, 1.5, 7), ("2024-01-03", 1.0, 2.0, 0.5, None, 7)], "Date string, OPEN double, High double, low double, Close double, Volume long")
    assert landed.wide_bars(wide, "A", "file", "1d").count() == 1
    items = spark.createDataFrame([("A", " x ", "l", "Mon, 01 Jul 2024 10:00:00 +0000"), ("A", "y", "l", None), ("A", "", "l", None), ("A", "old", "l", "Mon, 03 Jun 2024 10:00:00 GMT")], "ticker string, title string, link string, pubDate string")
    times = ["Mon, 01 Jul 2024 10:00:00 +0000", "1 Jul 2024 10:00 -0530", "Mon, 1 Jul 2024 10:00:00 EDT", "01 Jul 2024 10:00:00 +02:00", "Mon, 01 Jul 2024 10:00:00 GMT", "soon", None, ""]
    read = spark.createDataFrame([(k, t) for k, t in enumerate(times)], "k int, t string").select("k", landed.feed_time(F.col("t")).alias("t")).orderBy("k").collect()
    assert [str(r.t) if r.t else None for r in read] == ["2024-07-01 10:00:00", "2024-07-01 15:30:00", "2024-07-01 14:00:00", "2024-07-01 08:00:00", "2024-07-01 10:00:00", None, None, None]
    heads = landed.rss_headlines(items, F.lit("2024-07-02").cast("timestamp")).collect()
    assert {(r.headline, r.published_at is None) for r in heads} == {("x", False), ("y", True)}
    assert spark.range(1).select(landed.clean_tickers(F.lit(" aapl, ,Msft ")).alias("t")).first().t == ["AAPL", "MSFT"]


def test_sentiment(spark):
    df = spark.createDataFrame([("A", "s", "the for was thing"), ("A", "s", "that from"), ("B", "s", ""), ("B", "s", None), ("B", "s", "zzz")], "ticker string, source string, headline string")
    rows = [(r.sentiment, r.score_pos, r.score_neg, r.compound) for r in sentiment.by_lexicon(df).collect()]
    assert rows[:2] == [("positive", 0.75, 0.0, 0.75), ("negative", 0.0, 1.0, -1.0)] and rows[2] == ("neutral", 0.33, 0.33, 0.0) and rows[4][0] == "neutral"
    calls = sentiment.score(df.union(df), scorer=lambda texts: [(0.2, 0.7, 0.1) if t == "zzz" else None for t in texts])
    got = calls.collect()
    assert len(got) == 10 and {(r.sentiment, r.compound) for r in got if r.headline == "zzz"} == {("negative", -0.5)}
    assert {r.score_pos for r in got if r.headline != "zzz"} == {0.33}


def test_least_squares_and_autoregression(spark):
    rng = np.random.default_rng(4)
    rows = [(k, rng.normal(size=3).tolist(), float(rng.normal())) for k in "ab" for _ in range(50)]
    df = spark.createDataFrame([*rows, ("a", [1.0, None, 2.0], 1.0), ("b", [1.0, 1.0, 2.0], None)], "ticker string, x array<double>, y double").repartition(3)
    for r in linear.solve(linear.gram(df)).collect():
        x, y = (np.array([v[i] for v in rows if v[0] == r.ticker]) for i in (1, 2))
        beta, left, *_ = np.linalg.lstsq(x, y, rcond=None)
        assert r.n == 50 and np.allclose(r.beta, beta) and math.isclose(r.sigma, math.sqrt(left[0] / 47))
    phi, d = [0.5, -0.2, 0.1, 0.0, 0.15], [0.0] * 5
    for _ in range(4000):
        d.append(sum(p * d[-1 - k] for k, p in enumerate(phi)) + rng.normal())
    df = bars(spark, 1000 + np.cumsum(d))
    assert np.allclose(linear.solve(linear.gram(linear.ar_rows(df))).first().beta, phi, atol=0.06)
    got = linear.ar_forecast(df).orderBy("forecast_date").collect()
    widths = [r.upper_bound - r.lower_bound for r in got]
    assert len(got) == 7 and widths == sorted(widths) and abs(widths[0] / (2 * linear.Z95) - 1) < 0.05


def test_trend_and_season(spark):
    days = np.arange(900)
    df = bars(spark, 50 + 0.1 * days + 5 * np.sin(2 * np.pi * (days + 19723) / 7))
    held = linear.linear_holdout(df, 30).collect()
    assert len(held) == 30 and max(abs(r.trend_season - r.actual) for r in held) < 0.5


def test_ridge_meta(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(100, 10, (30, 2))
    y = 0.7 * x[:, 0] + 0.3 * x[:, 1] + 2
    rows = [("A", DAY + datetime.timedelta(i), float(y[i]), float(x[i, 0]), float(x[i, 1])) for i in range(30)]
    df = spark.createDataFrame(rows, "ticker string, ds date, actual double, m1 double, m2 double")
    w = ensemble.meta_weights(df, ["m1", "m2"])
    r = w.first()
    want = np.linalg.solve((x - x.mean(0)).T @ (x - x.mean(0)) + r.alpha * np.eye(2), (x - x.mean(0)).T @ (y - y.mean()))
    assert np.allclose(r.weights, want) and r.alpha == 0.01 and r.in_sample_mape < 0.01 and r.prequential_mape < 0.01
    assert ensemble.expanding(30) == [(9, 16), (16, 23), (23, 30)]
    got = ensemble.combine(df, w, ["m1", "m2"]).collect()
    assert np.allclose([g.ensemble for g in got], [g.actual for g in got], atol=0.01)


def test_forecast_tables(spark):
    rows = [("A", m, DAY, p, p - 1, p + 1, datetime.datetime(2024, 1, run)) for run in (1, 2) for m, p in (("x", 10.0 * run), ("y", 20.0)) if not (m == "y" and run == 2)]
    df = spark.createDataFrame(rows, "ticker string, model string, forecast_date date, predicted_close double, lower_bound double, upper_bound double, run_at timestamp")
    assert {(r.model, r.predicted_close) for r in forecasts.averaged(df).collect()} == {("x", 15.0), ("y", 20.0)}
    assert forecasts.pivoted(df, ["x", "y"]).first()[2:] == (20.0, 20.0)
    assert forecasts.pivoted(df, ["x", "z"], complete=True).count() == 0


def test_flags_of_quartiles_with_small_scores_are_no_anomalies(spark):
    """A return outside the fences whose score is under 2 is a flag, but its bar is not anomalous in the matrix; rows and blanks as specified."""
    from tidemark.operators.features import FEATURES, feature_matrix, flagged_frame

    closes, level = [], 100.0
    for k in range(60):
        level *= 1.5 if k == 45 else 1 / 1.5 if k == 46 else 1.03 if k % 10 == 3 else 1 / 1.03 if k % 10 == 4 else 1.0005 if k % 2 else 0.9995
        closes.append(level)
    rows = flagged_frame(bars(spark, closes))
    flags = {r.ds: r for r in rows.where("flag is not null").collect()}
    matrix = {r.ds: r for r in feature_matrix(rows).collect()}
    small = [r for r in flags.values() if abs(r.zscore) < 2]
    assert small and any(abs(r.zscore) >= 2 for r in flags.values())
    for day, r in matrix.items():
        assert r.is_anomaly == int(day in flags and abs(flags[day].zscore) >= 2) and all(r[f] is not None for f in FEATURES)
    assert len(matrix) == 60 - 20 and matrix[DAY + datetime.timedelta(19)].rsi_14 == 0 and matrix[DAY + datetime.timedelta(25)].rsi_14 > 0
    assert len(feature_matrix(rows, labelled=False).collect()) == 41


@pytest.mark.parametrize("cells", [1, 4, 256])
def test_exact_quantiles(spark, cells):
    from tidemark.functions.quantiles import exact_quantiles

    rng = np.random.default_rng(11)
    data = {"a": rng.normal(size=1001), "b": np.repeat([1.0, 2.0, 2.0, 5.0], 300), "c": [7.0], "d": [1.0, 4.0], None: rng.lognormal(0, 4, 500)}
    df = spark.createDataFrame([(k, float(v)) for k, vs in data.items() for v in vs] + [("a", None), ("e", None)], "ticker string, x double").repartition(3)
    shares = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {r.ticker: r for r in exact_quantiles(df, "x", shares, cells=max(2, cells)).collect()}
    assert set(got) == set(data)
    for k, v in data.items():
        assert got[k].n == len(v) and np.allclose(got[k].q, np.quantile(v, shares), rtol=1e-12)


def test_fences_of_long_series_are_those_of_short_ones(spark, monkeypatch):
    df = bars(spark, np.random.default_rng(5).lognormal(3, 1, 300)).union(bars(spark, np.random.default_rng(6).lognormal(3, 1, 100), "B"))
    key = lambda rows: sorted((r.ticker, r.ds, r.flag, round(r.zscore, 9)) for r in rows.collect())
    short = key(anomalies.merged_flags(df, time="ds"))
    monkeypatch.setattr(anomalies, "BUFFER", 0)
    assert short and key(anomalies.merged_flags(df, time="ds")) == short


def test_gates(spark):
    from tidemark.functions.series import skipped

    df = bars(spark, range(1, 60)).union(bars(spark, range(1, 26), "B")).union(bars(spark, range(1, 91), "C"))
    assert {(r.ticker, r.stage, r.n_rows, r.needed) for r in skipped(df).collect()} == {
        ("A", "forecast", 59, 60), ("A", "trees", 59, 60), ("A", "stack", 59, 90),
        ("B", "indicators", 25, 26), ("B", "zscore", 25, 30), ("B", "forecast", 25, 60), ("B", "trees", 25, 60), ("B", "stack", 25, 90),
    }


def test_late_rows_reach_the_backfill(spark, tmp_path):
    """A row behind the watermark is lost to the stream; the batch brings its bar. Compaction keeps what a reader sees."""
    from tidemark.streaming import bars as streams

    kind = "ticker string, ts timestamp, price double, seq long"
    at = lambda day, minute=0: datetime.datetime(2024, 1, day, 10, minute)
    first = spark.createDataFrame([("A", at(20), 1.0, 2), ("A", at(19), 2.0, 1)], kind)
    late = spark.createDataFrame([("A", at(10), 5.0, 0), ("A", at(18), 3.0, 0)], kind)
    landed_at, target = str(tmp_path / "in"), str(tmp_path / "out")
    for part in (first, late):
        part.write.mode("append").parquet(landed_at)
        table = streams.run_available(streams.tumbling(streams.read(spark, landed_at, first.schema, 100)), target, ["ticker", "ts"])
    assert {(r.ts, r.close) for r in table.collect()} == {(at(20), 1.0), (at(19), 2.0), (at(18), 3.0)}
    whole = streams.backfill(table, streams.batch_bars(late), ["ticker", "ts"])
    assert {(r.ts, r.close) for r in whole.collect()} == {(at(20), 1.0), (at(19), 2.0), (at(18), 3.0), (at(10), 5.0)}
    before = set(map(tuple, table.collect()))
    streams.compact(spark, f"{target}/table", ["ticker", "ts"])
    streams.compact(spark, f"{target}/table", ["ticker", "ts"])
    assert len([p for p in (tmp_path / "out" / "table").iterdir() if p.name.startswith("batch=")]) == 1
    assert set(map(tuple, streams.last_versions(spark, f"{target}/table", ["ticker", "ts"]).collect())) == before


def test_the_matrix_reads_its_bars_in_few_passes(spark, sf_dir):
    from tidemark.operators import features
    from tidemark.plans.series_queries import matrix
    from tidemark.sources.tables import daily_bars

    plan = features.frame(daily_bars(spark, sf_dir))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and plan.count("Exchange hashpartitioning") <= 7 and plan.count("CartesianProduct") == 0
    plan = matrix(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("orders.parquet") == 0 and plan.count("Window") == plan.count("Sort [") or plan.count("FileScan") <= 6


def test_plans_have_one_exchange_per_window_chain(spark, sf_dir):
    from tidemark.operators.features import price_features
    from tidemark.sources.tables import daily_bars

    df = bars(spark, range(50))
    plan = price_features(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "SinglePartition" not in plan
    scan = daily_bars(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "o_custkey" not in scan and "CartesianProduct" not in scan


@pytest.mark.parametrize("block", [19, 64, 10_000])
def test_blocks_of_a_long_series_are_the_plain_window(spark, block):
    from tidemark.functions.long_series import numbered, rolling_blocks
    from tidemark.functions.series import rolling

    df = bars(spark, np.random.default_rng(8).normal(size=400)).union(bars(spark, range(5), "B"))
    rows = numbered(df, F.date_trunc("month", "ds"), time="ds")
    assert [r._i for r in rows.where("ticker = 'A'").orderBy("ds").collect()] == list(range(400))
    got = rolling_blocks(rows, {"m": (F.avg, "close")}, 20, block=block).orderBy("ticker", "ds").collect()
    want = df.withColumn("m", rolling(F.avg, "close", 20, time="ds")).orderBy("ticker", "ds").collect()
    assert [r.m is None for r in got] == [r.m is None for r in want]
    assert np.allclose([r.m or 0 for r in got], [r.m or 0 for r in want])
    with pytest.raises(ValueError):
        rolling_blocks(rows, {}, 20, block=5)
