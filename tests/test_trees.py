"""Tree models and all that is built on them: values, with few trees; the registered queries ask for 300 (test_tree_rounds)."""

import datetime
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidemark.operators import boosting, ensemble, trees
from tidemark.operators.features import feature_matrix, flagged_frame
from tidemark.plans import table_queries
from tidemark.plans.registry import QUERIES

ROUNDS = 8


@pytest.fixture(scope="module")
def bars(spark):
    """Two series that go up after an odd and down after an even day's volume."""
    rng, rows = np.random.default_rng(3), []
    for ticker, close in (("A", 100.0), ("B", 5000.0)):
        day = datetime.date(2023, 1, 2)
        for _ in range(260):
            volume = int(rng.integers(1, 3)) * 1000
            rows.append((ticker, day, close * 0.99, close * 1.01, close * 0.98, close, volume))
            close *= 1.02 if volume == 2000 else 0.985
            day += datetime.timedelta(1)
    return spark.createDataFrame(rows, "ticker string, ds date, open double, high double, low double, close double, volume long")


@pytest.fixture(scope="module")
def matrix(bars):
    return feature_matrix(flagged_frame(bars), labelled=False).cache()


def test_forest_learns_and_sees_no_held_out_row(matrix, kind="forest"):
    rows = matrix.where("target_next_close is not null")
    got = trees.holdout(rows, kind, "p", rounds=60).toPandas()
    assert got.groupby("ticker").size().tolist() == [30, 30] and (got.ds > datetime.date(2023, 8, 1)).all()
    error = (got.p / got.actual - 1).abs().mean()
    assert error < 0.7 * (got.previous / got.actual - 1).abs().mean()
    # held-out targets do not matter
    spoiled = rows.withColumn("target_next_close", F.when(F.col("ds") > datetime.date(2023, 8, 19), 1.0).otherwise(F.col("target_next_close")))
    again = trees.holdout(spoiled, kind, "p", rounds=ROUNDS).toPandas().set_index(["ticker", "ds"]).p
    plain = trees.holdout(rows, kind, "p", rounds=ROUNDS).toPandas().set_index(["ticker", "ds"]).p
    assert np.allclose(again.sort_index(), plain.sort_index())


def test_relative_features(matrix):
    row, flat = matrix.orderBy("ticker", "ds").first(), trees.relative(matrix).orderBy("ticker", "ds").first()
    assert np.isclose(flat.close_lag_5, row.close_lag_5 / row.close - 1) and np.isclose(flat.rolling_std_10, row.rolling_std_10 / row.close)
    assert np.isclose(flat.label, row.target_next_close / row.close - 1) and np.isclose(flat.volume, np.log1p(row.volume)) and flat.rsi_14 == row.rsi_14


def test_registered_queries_with_few_trees(spark, sf_dir, monkeypatch):
    """Each query against its own inputs, in plain arithmetic."""
    monkeypatch.setattr(boosting, "KINDS", {k: replace(s, rate=0.3) for k, s in boosting.KINDS.items()})
    configured = entry.configure(spark)
    fits = table_queries.Fits(configured, sf_dir, held=(False, True), rounds=ROUNDS)
    names = ("gbt_holdout", "leafwise_holdout", "holdout_stack", "ridge_meta_weights", "model_comparison", "ensemble_forecast", "tree_forecast_7d", "feature_importance_top5", "ensemble_strategy")
    run = {name: QUERIES[name](configured, sf_dir, models=fits).toPandas() for name in names}
    models = ["ar5", "trend_season", "gbt", "leafwise"]
    stack = run["holdout_stack"]
    both = run["gbt_holdout"].merge(run["leafwise_holdout"][["ticker", "ds", "leafwise"]], on=["ticker", "ds"])
    assert len(both) == 150 and (both.naive == both.previous).all()
    again = stack[["ticker", "ds"]].merge(both, on=["ticker", "ds"])
    assert len(again) == len(stack) and np.allclose(again.gbt, stack.gbt) and np.allclose(again.leafwise, stack.leafwise) and stack.groupby("ticker").size().between(20, 30).all()
    for w in run["ridge_meta_weights"].itertuples():
        own = stack[stack.ticker == w.ticker].sort_values("ds")
        x, y = own[models].to_numpy(), own.actual.to_numpy()
        cv = {a: np.mean([np.mean(np.abs((y[s:e] - (x[s:e] @ (f := ensemble.ridge(x[:s], y[:s], a))[0] + f[1])) / y[s:e])) for s, e in ensemble.expanding(len(y))]) for a in ensemble.ALPHAS}
        assert w.n == len(own) and cv[w.alpha] == min(cv.values())
        mx, my = x.mean(0), y.mean()
        beta = np.linalg.solve((x - mx).T @ (x - mx) + w.alpha * np.eye(4), (x - mx).T @ (y - my))
        assert np.allclose(beta, w.weights) and np.isclose(w.in_sample_mape, 100 * np.mean(np.abs((y - x @ beta - (my - mx @ beta)) / y)))
        scored = run["model_comparison"]
        mine = scored[scored.ticker == w.ticker].set_index("model")
        assert np.isclose(mine.mape["ensemble"], w.in_sample_mape) and all(np.isclose(mine.mape[m], 100 * np.mean(np.abs((y - own[m]) / y))) for m in models)
        assert mine.loc[mine.mape.idxmin(), "rank"] == 1 and np.isclose(mine.improvement_pct["ensemble"], 100 * (1 - mine.mape["ensemble"] / mine.mape[models].min()))
        ahead = run["ensemble_forecast"]
        ahead = ahead[ahead.ticker == w.ticker]
        assert 0 < len(ahead) <= 7 and (ahead.model == "ensemble").all() and (ahead.lower_bound < ahead.upper_bound).all()
    assert len(run["tree_forecast_7d"]) == 2 * 5 * 7 and run["feature_importance_top5"].groupby("model")["rank"].apply(sorted).tolist() == [[1, 2, 3, 4, 5]] * 2
    strategy = run["ensemble_strategy"]
    assert len(strategy) == 25 and (strategy.max_drawdown <= 0).all() and strategy.alpha.is_monotonic_decreasing
