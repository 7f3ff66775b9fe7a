"""Trend with sparse changepoints and seasons, per series.

The trend is a line with hinges at ``CHANGES`` even places over the first 80 % of a series.  The fit is the mode of the posterior
under the usual priors, in units of the largest close: Laplace with scale ``tau`` on the changes of slope, normal with deviation 5 on
level and slope and 10 on the waves (Taylor and Letham 2018).  So hinges have an L1 penalty, the rest an L2 penalty, both in proportion to
the noise's variance, which is estimated in turn.  Each key is solved from its factor (:mod:`factors`): what has no L1 penalty is eliminated,
coordinate descent goes over the hinges,
and exact steps on the support it finds end at the optimum.

Intervals come from drawn futures: changes as often and as large, on average, as the fitted ones, plus noise.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.series import KEY
from .factors import factors

CHANGES, SPAN, WEEKLY, YEARLY = 25, 0.8, 3, 10
TAU, LINE, WAVES = 0.05, 5.0, 10.0
DRAWS = 1000
#: Least variance of the noise, in units of the largest close squared.
LEAST = 1e-8


def design(rows: DataFrame, span: DataFrame, time: str = "ds", changes: int = CHANGES, weekly: int = WEEKLY, yearly: int = YEARLY) -> DataFrame:
    """Add ``x``: level, trend, hinges, weekly and yearly waves; ``span`` has ``first`` and ``last`` of each key."""
    rows = rows.join(span.select(KEY, "first", "last"), KEY)
    t = F.try_divide(F.datediff(time, "first").cast("double"), F.greatest(F.datediff("last", "first"), F.lit(1)))
    day = F.datediff(F.col(time), F.lit("1970-01-01").cast("date")).cast("double")
    hinges = [F.greatest(t - SPAN * (k + 1) / (changes + 1), F.lit(0.0)) for k in range(changes)]
    waves = [f(2 * np.pi * k * day / period) for period, top in ((7.0, weekly), (365.25, yearly)) for k in range(1, top + 1) for f in (F.sin, F.cos)]
    return rows.withColumn("x", F.array(F.lit(1.0), t, *hinges, *waves)).drop("first", "last")


def lasso(g: np.ndarray, b: np.ndarray, l1: np.ndarray, l2: np.ndarray, start: np.ndarray | None = None, sweeps: int = 60) -> np.ndarray:
    """The minimum of ``beta g beta / 2 - b beta + sum(l1 |beta|) + sum(l2 beta^2) / 2`` for cross products ``g`` and ``b``."""
    free, bound = np.flatnonzero(l1 == 0), np.flatnonzero(l1 > 0)
    g = g + np.diag(l2)
    back = np.linalg.lstsq(g[np.ix_(free, free)], np.column_stack([g[np.ix_(free, bound)], b[free]]), rcond=None)[0] if len(free) else np.zeros((0, len(bound) + 1))
    h = g[np.ix_(bound, bound)] - g[np.ix_(bound, free)] @ back[:, :-1]
    c = b[bound] - g[np.ix_(bound, free)] @ back[:, -1]
    a, size = l1[bound], np.maximum(np.diag(h), 1e-300)
    w = np.zeros(len(bound)) if start is None else start[bound].copy()
    slope = c - h @ w
    for _ in range(sweeps):
        moved = 0.0
        for j in range(len(w)):
            if h[j, j] <= 1e-14 * max(g[bound[j], bound[j]], 1e-300):  # nothing of its own is left
                continue
            pull = slope[j] + h[j, j] * w[j]
            new = np.sign(pull) * max(abs(pull) - a[j], 0.0) / size[j]
            if new != w[j]:
                slope -= h[:, j] * (new - w[j])
                moved = max(moved, abs(new - w[j]) * np.sqrt(size[j]))
                w[j] = new
        if moved <= 1e-12 * np.sqrt(np.abs(c).max(initial=0.0) + 1e-300):
            break
    w = _settled(h, c, a, w)
    beta = np.zeros(len(b))
    beta[bound] = w
    beta[free] = back[:, -1] - back[:, :-1] @ w
    return beta


def _settled(h: np.ndarray, c: np.ndarray, a: np.ndarray, w: np.ndarray, most: int = 500) -> np.ndarray:
    """From where coordinate descent has come to the optimum itself: exact steps on the support, whose signs change one by one (Lee et al. 2006)."""
    value = lambda w: w @ h @ w / 2 - c @ w + a @ np.abs(w)
    near = 1e-10 * max(np.abs(c).max(initial=0.0), 1e-300)
    for _ in range(most):
        slope, sign = c - h @ w, np.sign(w)
        on = np.flatnonzero(w)
        if np.abs(slope[on] - a[on] * sign[on]).max(initial=0.0) <= near:
            off = np.where(w == 0, np.abs(slope) - a, -np.inf)
            j = int(np.argmax(off)) if len(off) else 0
            if not len(off) or off[j] <= near:
                break
            sign[j], on = np.sign(slope[j]), np.append(on, j)
        target = w.copy()
        target[on] = np.linalg.lstsq(h[np.ix_(on, on)], c[on] - a[on] * sign[on], rcond=None)[0]
        # to the best of the points where a coefficient changes its sign, or all the way
        steps = [(1.0, None)]
        steps += [(w[i] / (w[i] - target[i]), i) for i in on if w[i] * target[i] < 0]
        tried = []
        for step, i in steps:
            point = w + step * (target - w)
            if i is not None:
                point[i] = 0.0
            tried.append((value(point), step, point))
        best = min(tried, key=lambda x: x[:2])
        if best[0] >= value(w):  # nothing is left but rounding
            break
        w = best[2]
    return w


def lasso_of(found: DataFrame, l1: list[float]) -> DataFrame:
    """Level, slope and hinge of each key for given penalties, from factors of a design with one hinge and no waves."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for name, n, r in frame[[KEY, "n", "r"]].itertuples(index=False):
                k = round(len(r) ** 0.5)
                m = np.array(r).reshape(k, k)
                beta = lasso(m[:, :-1].T @ m[:, :-1], m[:, :-1].T @ m[:, -1], np.array(l1), np.zeros(k - 1))
                out.append((name, n, *map(float, beta)))
            yield pd.DataFrame(out, columns=[KEY, "n", "level", "slope", "hinge"])

    return found.mapInPandas(run, f"{KEY} string, n long, level double, slope double, hinge double")


def fit_factor(r: np.ndarray, n: int, top: float, changes: int = CHANGES, tau: float = TAU, rounds: int = 12) -> tuple[np.ndarray, float]:
    """Coefficients and noise deviation from one key's factor, both in units of the closes."""
    top = top or 1.0
    k = len(r) - 1
    x, y, rest = r[:k, :k], r[:k, k] / top, r[k, k] / top
    g, b = x.T @ x, x.T @ y
    hinge = np.zeros(k, bool)
    hinge[2 : 2 + changes] = True
    prior = np.where(np.arange(k) < 2, LINE, WAVES) ** -2.0
    variance, beta = max((y @ y + rest**2) / max(n, 1) / 100, LEAST), None
    for _ in range(rounds):
        before = variance
        beta = lasso(g, b, np.where(hinge, variance / tau, 0.0), np.where(hinge, 0.0, variance * prior), beta)
        variance = max((np.square(y - x @ beta).sum() + rest**2) / max(n, 1), LEAST)
        if abs(variance - before) <= 1e-6 * before:
            break
    return beta * top, float(np.sqrt(variance)) * top


def fit(rows: DataFrame, changes: int = CHANGES, tau: float = TAU) -> DataFrame:
    """From ``ticker, x, y``: ``n, beta, sigma`` and ``jump``, the mean size of the fitted changes of slope."""
    top = rows.groupBy(KEY).agg(F.max(F.abs("y")).alias("top"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for name, n, r, top in frame[[KEY, "n", "r", "top"]].itertuples(index=False):
                k = round(len(r) ** 0.5)
                beta, sigma = fit_factor(np.array(r).reshape(k, k), n, top, changes, tau)
                out.append((name, n, beta.tolist(), sigma, float(np.abs(beta[2 : 2 + changes]).mean()) if changes else 0.0))
            yield pd.DataFrame(out, columns=[KEY, "n", "beta", "sigma", "jump"])

    return factors(rows).join(top, KEY).mapInPandas(run, f"{KEY} string, n long, beta array<double>, sigma double, jump double")


def futures(t: np.ndarray, sigma: float, jump: float, seed: int, changes: int = CHANGES, draws: int = DRAWS) -> np.ndarray:
    """Deviations (draws x times) of drawn futures from the fitted trend at scaled times ``t``; the data end at 1."""
    rng, end = np.random.default_rng(seed), max(float(t.max(initial=1.0)), 1.0)
    many = rng.poisson(changes * (end - 1), draws)
    at = rng.uniform(1, end, (draws, max(int(many.max(initial=0)), 1)))
    size = rng.laplace(0, jump, at.shape) * (np.arange(at.shape[1]) < many[:, None])
    out = np.stack([(size * np.maximum(x - at, 0)).sum(axis=1) for x in t], axis=1)
    return out + rng.normal(0, sigma, out.shape)


def predict(bars: DataFrame, ahead: DataFrame, time: str = "ds", changes: int = CHANGES, tau: float = TAU, share: float = 0.95) -> DataFrame:
    """The model fitted on ``bars`` at the dates ``ticker, ds`` of ``ahead``, few of a series: ``predicted, lower, upper``."""
    span = bars.groupBy(KEY).agg(F.min(time).alias("first"), F.max(time).alias("last"))
    fitted = fit(design(bars.select(KEY, time, F.col("close").cast("double").alias("y")), span, time, changes), changes, tau)
    at = design(ahead.select(KEY, time), span, time, changes).join(fitted, KEY)
    dot = F.aggregate(F.zip_with("x", "beta", lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    points = at.select(KEY, "sigma", "jump", F.struct(F.col(time).alias("day"), F.col("x")[1].alias("t"), dot.alias("predicted")).alias("p"))
    series = points.groupBy(KEY).agg(F.first("sigma").alias("sigma"), F.first("jump").alias("jump"), F.sort_array(F.collect_list("p")).alias("p"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for name, sigma, jump, points in frame.itertuples(index=False):
                t = np.array([p["t"] for p in points], float)
                off = futures(t, sigma, jump, crc32(str(name).encode()), changes)
                low, high = np.quantile(off, [(1 - share) / 2, (1 + share) / 2], axis=0)
                out += [(name, p["day"], p["predicted"], p["predicted"] + a, p["predicted"] + b) for p, a, b in zip(points, low, high)]
            yield pd.DataFrame(out, columns=[KEY, time, "predicted", "lower", "upper"])

    return series.mapInPandas(run, f"{KEY} string, {time} {ahead.schema[time].dataType.simpleString()}, predicted double, lower double, upper double")
