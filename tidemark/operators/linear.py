"""Least squares per series over any number of series, and the forecasters built on it.

Partial cross products, or triangular factors (:mod:`factors`), are merged on the executors, batch by batch and then by
key; only one small matrix per series reaches the solver.  The forecasters use factors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.long_series import dealt, from_end
from ..functions.recurrence import inside, own
from ..functions.series import KEY, business_days, lag
from . import changepoints, factors

Z95 = 1.959963984540054


def gram(rows: DataFrame, key: str = KEY) -> DataFrame:
    """From ``key, x array<double>, y double``: ``n`` and ``g``, the flattened cross products of (x, y), per key."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for name, part in frame.groupby(key, sort=False):
                z = np.column_stack([np.stack(part["x"].to_numpy()), part["y"].to_numpy()])
                out.append((name, len(z), (z.T @ z).ravel().tolist()))
            yield pd.DataFrame(out, columns=[key, "n", "g"])

    kind = rows.schema[key].dataType.simpleString()
    rows = rows.select(key, "x", F.col("y").cast("double").alias("y")).where("y is not null and not exists(x, v -> v is null)")
    parts = rows.mapInPandas(run, f"{key} {kind}, n long, g array<double>")
    counts = parts.groupBy(key).agg(F.sum("n").alias("n"))
    cells = parts.select(key, F.posexplode("g").alias("at", "v")).groupBy(key, "at").agg(F.sum("v").alias("v"))
    sums = cells.groupBy(key).agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "v"))), lambda c: c["v"]).alias("g"))
    return counts.join(sums, key)


def solve(sums: DataFrame, penalty: list[float] | float = 0.0, key: str = KEY) -> DataFrame:
    """Coefficients ``beta`` and residual deviation ``sigma`` per key, with an L2 penalty on each coefficient."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for name, n, g in frame[[key, "n", "g"]].itertuples(index=False):
                k = round(len(g) ** 0.5) - 1
                m = np.array(g).reshape(k + 1, k + 1)
                a, b = m[:k, :k] + np.diag(np.broadcast_to(penalty, k)), m[:k, k]
                beta = np.linalg.lstsq(a, b, rcond=None)[0]
                left = m[k, k] - 2 * beta @ b + beta @ m[:k, :k] @ beta
                out.append((name, n, beta.tolist(), float(np.sqrt(max(left, 0) / max(n - k, 1)))))
            yield pd.DataFrame(out, columns=[key, "n", "beta", "sigma"])

    kind = sums.schema[key].dataType.simpleString()
    return sums.mapInPandas(run, f"{key} {kind}, n long, beta array<double>, sigma double")


def ar_rows(bars: DataFrame, p: int = 5, time: str = "ds") -> DataFrame:
    """First differences as ``y`` and their p lags as ``x``, in blocks of a series."""
    rows, at = dealt(bars.select(KEY, time, "close"), p + 1, time=time), (inside(KEY), "_i")
    rows = rows.withColumn("y", F.col("close") - lag("close", 1, *at))
    return own(rows.withColumn("x", F.array(*[lag("y", k, *at) for k in range(1, p + 1)]))).drop("_i")


def ar_paths(bars: DataFrame, steps: int, p: int = 5, time: str = "ds") -> DataFrame:
    """Autoregression on first differences: ``ticker, step, predicted, se`` for the next steps of every series.

    Conditional least squares without constant; the error of a step follows from
    the psi weights of the integrated process.
    """
    rows = ar_rows(bars, p, time)
    fitted = factors.solve(factors.factors(rows))
    last = rows.groupBy(KEY).agg(F.max_by(F.struct("close", "y", "x"), time).alias("s"))
    state = last.select(KEY, F.col("s.close").alias("close"), F.concat(F.array("s.y"), F.slice("s.x", 1, p - 1)).alias("past"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for name, close, past, beta, sigma in frame.itertuples(index=False):
                beta, past, level = np.array(beta), list(past), close
                psi = [1.0]
                for h in range(1, steps + 1):
                    d = float(beta @ np.array(past[:p], float))
                    past, level = [d, *past], level + d
                    out.append((name, h, level, float(sigma * np.sqrt(np.sum(np.cumsum(psi) ** 2)))))
                    psi.append(float(sum(beta[i] * psi[h - 1 - i] for i in range(min(p, h)))))
            yield pd.DataFrame(out, columns=[KEY, "step", "predicted", "se"])

    return state.join(fitted.select(KEY, "beta", "sigma"), KEY).mapInPandas(run, f"{KEY} string, step int, predicted double, se double")


def with_bounds(rows: DataFrame, model: str, time: str = "ds") -> DataFrame:
    """Forecast rows with 95 % bounds."""
    return rows.select(KEY, F.lit(model).alias("model"), F.col(time).alias("forecast_date"), F.col("predicted").alias("predicted_close"), (F.col("predicted") - Z95 * F.col("se")).alias("lower_bound"), (F.col("predicted") + Z95 * F.col("se")).alias("upper_bound"))


def next_days(bars: DataFrame, n: int = 7, time: str = "ds") -> DataFrame:
    """The next n business days of every series: ``ticker, ds, step``."""
    last = bars.groupBy(KEY).agg(F.max(time).alias("last"))
    return last.select(KEY, F.posexplode(business_days("last", n)).alias("at", time)).select(KEY, time, (F.col("at") + 1).alias("step"))


def ar_forecast(bars: DataFrame, n: int = 7, time: str = "ds", p: int = 5) -> DataFrame:
    rows = ar_paths(bars, n, p, time).join(next_days(bars, n, time), [KEY, "step"])
    return with_bounds(rows, f"ar{p}", time)


def trend_forecast(bars: DataFrame, n: int = 7, time: str = "ds") -> DataFrame:
    rows = changepoints.predict(bars, next_days(bars, n, time), time)
    return rows.select(KEY, F.lit("trend_season").alias("model"), F.col(time).alias("forecast_date"), F.col("predicted").alias("predicted_close"), F.col("lower").alias("lower_bound"), F.col("upper").alias("upper_bound"))


def linear_holdout(bars: DataFrame, n: int = 30, time: str = "ds") -> DataFrame:
    """Predictions of both models for the last n bars, fitted on the bars before: ``ticker, ds, actual, ar5, trend_season``.

    Aligned by date: step h of the autoregression belongs to the h-th held-out bar.
    """
    marked = from_end(bars, n, time=time)
    before, held = marked.where("_back is null"), marked.where("_back is not null")
    held = held.select(KEY, time, F.col("close").alias("actual"), (n + 1 - F.col("_back")).alias("step"))
    ar = ar_paths(before, n, time=time).select(KEY, "step", F.col("predicted").alias("ar5"))
    trend = changepoints.predict(before, held, time).select(KEY, time, F.col("predicted").alias("trend_season"))
    return held.join(ar, [KEY, "step"]).join(trend, [KEY, time]).select(KEY, time, "actual", "ar5", "trend_season")
