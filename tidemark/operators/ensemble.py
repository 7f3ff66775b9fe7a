"""Stacking: a ridge regression of the held-out closes on the base models' predictions, per series.

A series enters with its held-out rows alone, a fixed number, so a group is bounded.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.series import KEY

# The grid of penalties.
ALPHAS = [0.01, 0.1, 0.5, 1.0, 5.0, 10.0, 50.0]
FOLDS = 3


def stack(parts: list[DataFrame]) -> DataFrame:
    """Join the held-out predictions of all models on ticker and date; dates that one lacks are left out."""
    out = parts[0]
    for part in parts[1:]:
        out = out.join(part.drop(*[c for c in ("actual", "previous") if c in out.columns]), [KEY, "ds"])
    return out


def ridge(x: np.ndarray, y: np.ndarray, alpha: float) -> tuple[np.ndarray, float]:
    """Ridge coefficients with a free intercept."""
    mx, my = x.mean(axis=0), y.mean()
    w = np.linalg.solve((x - mx).T @ (x - mx) + alpha * np.eye(x.shape[1]), (x - mx).T @ (y - my))
    return w, float(my - mx @ w)


def _mape(y: np.ndarray, p: np.ndarray) -> float:
    return float(np.mean(np.abs((y - p) / y)) * 100)


def expanding(n: int, folds: int = FOLDS) -> list[tuple[int, int]]:
    """Bounds (train end, test end) of expanding time folds with equal test sizes."""
    size = n // (folds + 1)
    return [(n - (folds - k) * size, n - (folds - k - 1) * size) for k in range(folds)]


def meta_weights(stacked: DataFrame, models: list[str]) -> DataFrame:
    """Per ticker: penalty of the least mean fold MAPE (the first on ties), weights, intercept, in-sample and prequential MAPE.

    The prequential error of a row uses weights fitted on the rows before it only.
    """

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("ds")
        x, y = frame[models].to_numpy(float), frame["actual"].to_numpy(float)
        cv = [np.mean([_mape(y[a:b], x[a:b] @ (f := ridge(x[:a], y[:a], alpha))[0] + f[1]) for a, b in expanding(len(y))]) for alpha in ALPHAS]
        best = int(np.argmin(cv))
        w, c = ridge(x, y, ALPHAS[best])
        start = expanding(len(y))[0][0]
        ahead = [x[i] @ (f := ridge(x[:i], y[:i], ALPHAS[best]))[0] + f[1] for i in range(start, len(y))]
        return pd.DataFrame([(frame[KEY].iloc[0], len(y), ALPHAS[best], w.tolist(), c, _mape(y, x @ w + c), _mape(y[start:], np.array(ahead)))], columns=[KEY, "n", "alpha", "weights", "intercept", "in_sample_mape", "prequential_mape"])

    kind = f"{KEY} string, n long, alpha double, weights array<double>, intercept double, in_sample_mape double, prequential_mape double"
    return stacked.where(" and ".join(f"{m} is not null" for m in [*models, "actual"])).groupBy(KEY).applyInPandas(run, kind)


def combine(wide: DataFrame, weights: DataFrame, models: list[str], into: str = "ensemble") -> DataFrame:
    """The ensemble's value in rows that have one column per model."""
    total = F.col("intercept")
    for k, m in enumerate(models):
        total = total + F.col("weights")[k] * F.col(m)
    return wide.join(weights.select(KEY, "weights", "intercept"), KEY).withColumn(into, total).drop("weights", "intercept")


def forecast(base: DataFrame, weights: DataFrame, models: list[str]) -> DataFrame:
    """Ensemble forecast on dates that all models have; bounds are the base bounds weighted by the shares of the absolute weights."""
    aggregates = [F.max(c).alias(a) for c, a in (("predicted_close", "p"), ("lower_bound", "l"), ("upper_bound", "u"))]
    wide = base.where(F.col("model").isin(models)).groupBy(KEY, "forecast_date").pivot("model", models).agg(*aggregates)
    wide = wide.dropna(subset=[f"{m}_p" for m in models]).join(weights.select(KEY, "weights", "intercept"), KEY)
    size = F.aggregate("weights", F.lit(0.0), lambda s, w: s + F.abs(w))
    point, low, high = F.col("intercept"), F.lit(0.0), F.lit(0.0)
    for k, m in enumerate(models):
        share = F.try_divide(F.abs(F.col("weights")[k]), size)
        point = point + F.col("weights")[k] * F.col(f"{m}_p")
        low, high = low + share * F.coalesce(f"{m}_l", F.lit(0.0)), high + share * F.coalesce(f"{m}_u", F.lit(0.0))
    return wide.select(KEY, F.lit("ensemble").alias("model"), "forecast_date", point.alias("predicted_close"), low.alias("lower_bound"), high.alias("upper_bound"))
