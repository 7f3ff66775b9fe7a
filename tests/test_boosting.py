"""The growers against plain recursive ones, whatever the dealing of rows; what the models are used for."""

import datetime
import heapq
from dataclasses import replace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import boosting
from tidemark.operators.boosting import Settings
from tidemark.operators.features import FEATURES, feature_matrix, flagged_frame

NAMES = [f"f{j}" for j in range(5)]


@pytest.fixture(scope="module")
def table():
    rng, m = np.random.default_rng(1), 400
    x = np.column_stack([rng.integers(0, 12, m), rng.normal(0, 1, m).round(1), rng.integers(0, 3, m), rng.exponential(1, m).round(1), np.zeros(m)])
    y = 0.3 * x[:, 0] + np.sin(3 * x[:, 1]) + (x[:, 2] > 1) * x[:, 3] + rng.normal(0, 0.1, m)
    return pd.DataFrame(x, columns=NAMES).assign(label=y, k=np.arange(m), back=np.arange(m) >= 350)


def dealt(spark, table, parts):
    return boosting.blocks(spark.createDataFrame(table).repartition(parts).persist(), NAMES, "label", ["k"], "back")


def plain(x, y, key, s: Settings):
    """Predictions after each tree by growing on lists of rows, best leaf first."""
    base, width = y.mean(), x.shape[1]
    pred, out = np.full(len(y), base), []
    for t in range(s.rounds):
        columns = np.sort(np.random.default_rng([s.seed, t]).permutation(width)[: max(1, round(s.columns * width))])
        mine = boosting.drawn(key, s.seed, t, s.rows)
        g = pred - y

        def split(rows, depth):
            best = (0.0, None)
            inside = rows[mine[rows]]
            score = lambda r: g[r].sum() ** 2 / (len(r) + s.l2) if len(r) + s.l2 else 0.0  # noqa: B023,E731
            for f in columns if depth < s.depth else []:
                for edge in np.unique(x[:, f])[:-1]:
                    low, high = inside[x[inside, f] <= edge], inside[x[inside, f] > edge]
                    if min(len(low), len(high)) >= max(s.least_rows, 1):
                        gain = (score(low) + score(high) - score(inside)) / 2
                        if gain > best[0] + 1e-9:
                            best = (gain, (f, edge))
            return best

        every = np.arange(len(y))
        queue, leaves, n = [], [], 0
        heapq.heappush(queue, (-split(every, 0)[0], 0, every, 0))
        while queue:
            gain, _, rows, depth = heapq.heappop(queue)
            if gain >= 0 or len(queue) + len(leaves) + 1 >= (s.leaves or 10**9):
                leaves.append(rows)
                continue
            f, edge = split(rows, depth)[1]
            for part in (rows[x[rows, f] <= edge], rows[x[rows, f] > edge]):
                n += 1
                heapq.heappush(queue, (-split(part, depth + 1)[0], n, part, depth + 1))
        for rows in leaves:
            inside = rows[mine[rows]]
            if len(inside) + s.l2:
                pred[rows] -= s.rate * g[inside].sum() / (len(inside) + s.l2)
        out.append(pred.copy())
    return out


SETTINGS = {
    "newton": Settings(rounds=5, depth=3, rate=0.3),
    "whole": Settings(rounds=2, depth=2, rows=1.0, columns=1.0, l2=5.0, least_rows=30),
    "leaves": Settings(rounds=5, depth=8, rate=0.3, l2=0.0, least_rows=10, leaves=6),
    "few": Settings(rounds=3, depth=4, leaves=3, held=False),
    "deep": Settings(rounds=2, depth=6, leaves=31, l2=0.0, least_rows=2, columns=1.0),
}


def test_trees_equal_plain_growing(spark, table):
    made = dealt(spark, table, 3)
    for name, trees in zip(SETTINGS, boosting.fit(made, list(SETTINGS.values())), strict=True):
        s = SETTINGS[name]
        own = table if s.held else table[~table.back]
        keys = spark.createDataFrame(own[["k"]]).select(F.xxhash64("k")).toPandas().iloc[:, 0].to_numpy().view(np.uint64)
        x = own[NAMES].to_numpy()
        for t, want in enumerate(plain(x, own.label.to_numpy(), keys, s)):
            got = np.full(len(own), trees.base)
            trees.add(trees.bins_of(x), got, 0, t + 1)
            assert np.allclose(got, want, atol=1e-7), (name, t)
        if s.leaves:
            assert ((trees.feature >= 0).sum(axis=1) < s.leaves).all()


def test_leaves_and_gain_have_closed_forms(spark, table):
    s = Settings(rounds=1, depth=1, rate=1.0, rows=1.0, columns=1.0, l2=2.5)
    (tree,) = boosting.fit(dealt(spark, table, 2), [s])
    f, edge = tree.feature[0, 0], tree.edges[tree.feature[0, 0]][tree.bin[0, 0]]
    g = (table.label.mean() - table.label).to_numpy()
    low = table[NAMES[f]].to_numpy() <= edge
    weight = lambda part: -part.sum() / (len(part) + 2.5)
    score = lambda part: part.sum() ** 2 / (len(part) + 2.5)
    assert np.allclose(tree.value[0, 1:], [weight(g[low]), weight(g[~low])], atol=1e-8)
    assert np.isclose(tree.gain[0, 0], (score(g[low]) + score(g[~low]) - score(g)) / 2, atol=1e-6)
    assert tree.importances()[NAMES[f]] == 1.0


def test_same_trees_however_rows_are_dealt(spark, table, monkeypatch):
    whole = boosting.fit(dealt(spark, table, 1), [SETTINGS["leaves"]])[0]
    monkeypatch.setattr(boosting, "BLOCK", 37)  # several blocks, so that every pass is a job
    made = dealt(spark, table.sample(frac=1, random_state=4), 7)
    assert made.frame.count() > 7
    again = boosting.fit(made, [SETTINGS["leaves"], SETTINGS["few"]])[0]
    for a, b in ((whole.feature, again.feature), (whole.bin, again.bin), (whole.value, again.value)):
        assert (a == b).all()


def test_many_values_have_quantile_edges(spark):
    rows = spark.range(5000).selectExpr("id", "cast(id as double) as f0", "cast(id % 7 as double) as f1", "cast(id > 2500 as double) as label", "0.0 as f2", "cast(null as double) as f3")
    edges = boosting.edges_of(rows, ["f0", "f1", "f2", "f3"])
    assert 200 < len(edges[0]) <= 254 and edges[1].tolist() == [0, 1, 2, 3, 4, 5] and not len(edges[2]) and not len(edges[3])
    made = boosting.blocks(rows, ["f0", "f1", "f2", "f3"], "label", ["id"])
    (tree,) = boosting.fit(made, [Settings(rounds=1, depth=1, rows=1.0, columns=1.0)])
    assert tree.feature[0, 0] == 0 and abs(tree.edges[0][tree.bin[0, 0]] - 2500) < 25


def test_odd_tables(spark):
    schema = "f0 double, label double, k long"
    for rows in ([], [(1.0, None, 1)], [(1.0, 5.0, 1)], [(1.0, 5.0, 1)] * 9):
        (tree,) = boosting.fit(boosting.blocks(spark.createDataFrame(rows, schema), ["f0"], "label", ["k"]), [Settings(rounds=2, depth=2)])
        assert np.allclose(tree.predict(np.array([[3.0]])), 5.0 if rows and rows[0][1] else 0.0) and (tree.feature == -1).all()


# --- over bars ---


@pytest.fixture(scope="module")
def bars(spark):
    """Two series that go up after an odd and down after an even day's volume, and one too short for some windows."""
    rng, rows = np.random.default_rng(3), []
    for ticker, close, n in (("A", 100.0, 260), ("B", 5000.0, 260), ("C", 10.0, 24)):
        day = datetime.date(2023, 1, 2)
        for _ in range(n):
            volume = int(rng.integers(1, 3)) * 1000
            rows.append((ticker, day, close * 0.99, close * 1.01, close * 0.98, close, volume))
            close *= 1.02 if volume == 2000 else 0.985
            day += datetime.timedelta(1)
    return spark.createDataFrame(rows, "ticker string, ds date, open double, high double, low double, close double, volume long")


@pytest.fixture(scope="module")
def matrix(bars):
    return feature_matrix(flagged_frame(bars), labelled=False).cache()


def few(**more):
    return {k: replace(s, rounds=25, **more) for k, s in boosting.KINDS.items()}


def test_holdout_learns_and_sees_no_held_out_row(matrix):
    rows = matrix.where("target_next_close is not null and ticker <> 'C'")
    got = boosting.holdout(boosting.learn(rows, {k: replace(s, rate=0.2) for k, s in few(held=False).items()}), rows).toPandas()
    assert got.groupby("ticker").size().tolist() == [30, 30] and (got.ds > datetime.date(2023, 8, 1)).all()
    for kind in boosting.KINDS:
        assert (got[kind] / got.actual - 1).abs().mean() < 0.7 * (got.previous / got.actual - 1).abs().mean()
    spoiled = rows.withColumn("target_next_close", F.when(F.col("ds") > datetime.date(2023, 8, 19), 1.0).otherwise(F.col("target_next_close")))
    plain = [boosting.learn(r, few(held=False)) for r in (rows, spoiled)]
    for kind in boosting.KINDS:
        a, b = plain[0][kind], plain[1][kind]
        assert (a.feature == b.feature).all() and np.allclose(a.value, b.value)
    shares = boosting.importances(plain[0], matrix.sparkSession).toPandas()
    for _, own in shares.groupby("model"):
        assert len(own) == len(FEATURES) + 1 and np.isclose(own.importance.sum(), 1) and own.loc[own.importance.idxmax(), "feature"] in ("volume", "volume_change")


def test_forecast_rolls_forward(spark, bars, matrix):
    """Each step by hand: the features of the bars so far through the same models."""
    models = boosting.learn(matrix.where("target_next_close is not null"), few())
    frame = boosting.forecast(models, bars, matrix, n=3)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "ExistingRDD" not in plan.split("MapInArrow")[0]
    got = frame.toPandas()
    assert len(got) == 18 and np.allclose(got.upper_bound, 1.02 * got.predicted_close) and np.allclose(got.lower_bound, 0.98 * got.predicted_close)
    for (ticker, model), mine in got.groupby(["ticker", "model"]):
        own = bars.where(F.col("ticker") == ticker).orderBy("ds").toPandas()
        last = matrix.where(F.col("ticker") == ticker).orderBy(F.col("ds").desc()).first().asDict()
        for r in mine.sort_values("forecast_date").itertuples():
            c = own.close
            row = dict(last, close=c.iloc[-1], ds=own.ds.iloc[-1], **{f: own[f].iloc[-1] for f in ("open", "high", "low", "volume")})
            row |= {f"close_lag_{k}": c.iloc[-1 - k] for k in (1, 2, 3, 5, 10)} | {f"return_{k}d": c.iloc[-1] / c.iloc[-1 - k] - 1 for k in (1, 5)}
            row |= {f"rolling_mean_{n}": c.iloc[-n:].mean() for n in (5, 10, 20)} | {f"rolling_std_{n}": c.iloc[-n:].std() for n in (5, 10, 20)}
            row |= {"hl_range": row["high"] - row["low"], "volume_change": own.volume.iloc[-1] / own.volume.iloc[-2] - 1}
            one = spark.createDataFrame(pd.DataFrame([{c: row[c] for c in ["ticker", "ds", "close", *FEATURES]}]))
            want = boosting.predict({model: models[model]}, one).first()[model]
            assert np.isclose(r.predicted_close, want) and r.forecast_date > row["ds"] and r.forecast_date.weekday() < 5
            own = pd.concat([own, pd.DataFrame([dict(ticker=ticker, ds=r.forecast_date, open=want, high=want, low=want, close=want, volume=own.volume.iloc[-1])])], ignore_index=True)


def test_predict_keeps_columns(matrix):
    models = boosting.learn(matrix.where("target_next_close is not null"), {"label": Settings(rounds=3)})
    got = boosting.predict(models, matrix)
    assert got.columns == [*matrix.columns, "label"] and got.drop("label").exceptAll(matrix).count() == 0
