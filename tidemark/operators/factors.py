"""Least squares per key from triangular factors.

The factor R of the rows (x, y) of a key, from a QR decomposition, holds all that a fit needs in ``(k + 1)^2`` numbers.  Factors of
parts stack: the factor of two of them is that of the rows of both.  So tasks factor what they hold, factors are merged in two
rounds, and a stored factor takes in new rows without the old ones being read.  The condition number of the design enters once,
not squared as in cross products.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.series import KEY

#: Keys whose factors a task holds at once, and groups of tasks that are merged first.
HELD, GROUPS = 1024, 64


def merged(parts: list[np.ndarray]) -> np.ndarray:
    """The factor of rows, or factors, on top of each other: square, upper triangular, no negative diagonal."""
    rows = np.vstack(parts)
    r = np.linalg.qr(rows, mode="r")
    r = np.vstack([r, np.zeros((rows.shape[1] - len(r), rows.shape[1]))])
    return np.triu(r) * np.where(np.diag(r) < 0, -1.0, 1.0)[:, None]


def factors(rows: DataFrame, key: str = KEY) -> DataFrame:
    """From ``key, x array<double>, y double``: ``n`` and ``r``, the flattened factor of (x, y), per key.  Rows with a null are left out."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        group, held = TaskContext.get().partitionId() % GROUPS, {}

        def out() -> pd.DataFrame:
            rows = [(name, group, n, r.ravel().tolist()) for name, (n, r) in held.items()]
            held.clear()
            return pd.DataFrame(rows, columns=[key, "group", "n", "r"])

        for frame in frames:
            for name, part in frame.groupby(key, sort=False, dropna=False):
                name = None if pd.isna(name) else name
                z = np.column_stack([np.stack(part["x"].to_numpy()), part["y"].to_numpy()])
                n, r = held.get(name, (0, z[:0]))
                held[name] = n + len(z), merged([r, z])
                if len(held) > HELD:
                    yield out()
        yield out()

    kind = rows.schema[key].dataType.simpleString()
    rows = rows.select(key, "x", F.col("y").cast("double").alias("y")).where("y is not null and not exists(x, v -> v is null)")
    return merge(rows.mapInPandas(run, f"{key} {kind}, group int, n long, r array<double>"), key)


def merge(parts: DataFrame, key: str = KEY) -> DataFrame:
    """One factor per key from several (``key, n, r`` and, if there are many of a key, ``group``)."""
    kind = parts.schema[key].dataType.simpleString()

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        k = round(len(frame["r"].iloc[0]) ** 0.5)
        r = merged([np.array(v).reshape(k, k) for v in frame["r"]])
        return pd.DataFrame({key: frame[key].iloc[:1], "n": [int(frame["n"].sum())], "r": [r.ravel().tolist()]})

    if "group" in parts.columns:
        parts = parts.groupBy(key, "group").applyInPandas(run, f"{key} {kind}, n long, r array<double>")
    return parts.groupBy(key).applyInPandas(run, f"{key} {kind}, n long, r array<double>")


def update(stored: DataFrame, rows: DataFrame, key: str = KEY) -> DataFrame:
    """Stored factors with new rows taken in; the rows they were made from are not needed."""
    return merge(stored.select(key, "n", "r").unionByName(factors(rows, key)), key)


def solved(r: np.ndarray, n: int, penalty: list[float] | float = 0.0) -> tuple[np.ndarray, float]:
    """Coefficients and residual deviation, with an L2 penalty on each coefficient."""
    k = len(r) - 1
    design = np.vstack([r[:k, :k], np.diag(np.sqrt(np.broadcast_to(penalty, k)))])
    beta = np.linalg.lstsq(design, np.append(r[:k, k], np.zeros(k)), rcond=None)[0]
    left = np.square(r[:k, :k] @ beta - r[:k, k]).sum() + r[k, k] ** 2
    return beta, float(np.sqrt(left / max(n - k, 1)))


def solve(found: DataFrame, penalty: list[float] | float = 0.0, key: str = KEY) -> DataFrame:
    """``key, n, beta, sigma`` from factors."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for name, n, r in frame[[key, "n", "r"]].itertuples(index=False):
                k = round(len(r) ** 0.5)
                beta, sigma = solved(np.array(r).reshape(k, k), n, penalty)
                out.append((name, n, beta.tolist(), sigma))
            yield pd.DataFrame(out, columns=[key, "n", "beta", "sigma"])

    kind = found.schema[key].dataType.simpleString()
    return found.mapInPandas(run, f"{key} {kind}, n long, beta array<double>, sigma double")
