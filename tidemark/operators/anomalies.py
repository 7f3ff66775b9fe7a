"""Anomaly flags: rolling z-score on closes and quartile fences on returns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import day_sketches
from ..functions.lineage import stored
from ..functions.long_series import dealt
from ..functions.quantiles import exact_quantiles
from ..functions.recurrence import inside, own
from ..functions.series import GATES, KEY, TIME, change, rolling

#: Rows of the rolling score; also how many a series needs to be scored.
WINDOW, THRESHOLD = GATES["zscore"], 2.0
#: A series of at most so many returns, by count, has its quartiles from one buffer; a longer one from cells, with the same result.
BUFFER = 1 << 20


def with_scores(rows: DataFrame, n: int = WINDOW, key: str = KEY) -> DataFrame:
    """Dealt rows with ``z``, deviations of the close from the mean of the last n closes, itself included, and ``r``, the percent return."""
    at = inside(key), "_i"
    z = F.try_divide(F.col("close") - rolling(F.avg, "close", n, *at), rolling(F.stddev_samp, "close", n, *at))
    return rows.withColumns({"z": z, "r": 100 * change("close", 1, *at)})


def fences(rows: DataFrame, k: float = 1.5, fit_until: Column | None = None, key: str = KEY, time: str = TIME) -> DataFrame:
    """``key, fence_low, fence_high, fence_mean, fence_sd`` of the returns ``r``: exact quartile fences of each series, or of its rows up to ``fit_until``."""
    fit = (rows if fit_until is None else rows.where(F.col(time) <= fit_until)).where("r is not null")
    spread = [F.avg("r").alias("fence_mean"), F.stddev_samp("r").alias("fence_sd")]
    longest = fit.groupBy(key).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    if longest <= BUFFER:
        q = fit.groupBy(key).agg(F.percentile("r", F.array(F.lit(0.25), F.lit(0.75))).alias("q"), *spread)
    else:
        means = fit.groupBy(F.col(key).alias("_k")).agg(*spread)
        q = exact_quantiles(fit, "r", [0.25, 0.75], key).join(means, F.col(key).eqNullSafe(F.col("_k")))
    return _edges(q, k, key)


def _edges(q: DataFrame, k: float, key: str) -> DataFrame:
    edge = F.lit(k) * (F.col("q")[1] - F.col("q")[0])
    return q.select(key, (F.col("q")[0] - edge).alias("fence_low"), (F.col("q")[1] + edge).alias("fence_high"), "fence_mean", "fence_sd")


def add_returns(rows: DataFrame, path: str, period: Column, key: str = KEY, files: int = 8) -> None:
    """Add the returns ``r`` of whole periods to a store of summaries; what it holds of other periods is not read."""
    day_sketches.add(rows, path, "r", period, key, files)


def stored_fences(spark: SparkSession, path: str, k: float = 1.5, first: str | None = None, last: str | None = None, kind: str = "string", key: str = KEY) -> DataFrame:
    """:func:`fences` of the periods from ``first`` to ``last`` of a store: equal quartiles; of the returns only the cells of a quartile are read."""
    q = day_sketches.quantiles(spark, path, [0.25, 0.75], kind, key, first, last)
    spread = day_sketches.moments(day_sketches.span_summaries(spark, path, kind, first, last), "_wk")
    spread = spread.select("_wk", F.col("mean").alias("fence_mean"), F.col("sd").alias("fence_sd"))
    return _edges(q.join(spread, F.col(key).eqNullSafe(F.col("_wk"))), k, key)


def flagged(rows: DataFrame, limits: DataFrame, threshold: float = THRESHOLD, key: str = KEY) -> DataFrame:
    """Rows with ``z`` and ``r`` get ``zscore, flag, by_z, by_fence``; of a row that both rules flag the z-score counts; null where neither does."""
    limits = limits.withColumnRenamed(key, "_k")
    rows = rows.join(limits, F.col(key).eqNullSafe(F.col("_k")), "left")
    by_z = F.coalesce(F.abs("z") >= threshold, F.lit(False))
    by_fence = F.coalesce((F.col("r") < F.col("fence_low")) | (F.col("r") > F.col("fence_high")), F.lit(False))
    side = lambda c: F.when(F.col(c) > 0, "HIGH").otherwise("LOW")
    rows = rows.withColumns({
        "by_z": by_z,
        "by_fence": by_fence,
        "zscore": F.when(by_z, F.col("z")).when(by_fence, F.try_divide(F.col("r") - F.col("fence_mean"), "fence_sd")),
        "flag": F.when(by_z, side("z")).when(by_fence, side("r")),
    })
    return rows.drop("_k", "fence_low", "fence_high", "fence_mean", "fence_sd")


def scored(bars: DataFrame, n: int = WINDOW, key: str = KEY, time: str = TIME) -> DataFrame:
    """``key, time, close, z, r`` of every bar."""
    return own(with_scores(dealt(bars.select(key, time, "close"), n, key=key, time=time), n, key)).drop("_i")


def zscore_flags(bars: DataFrame, n: int = WINDOW, threshold: float = THRESHOLD, key: str = KEY, time: str = TIME) -> DataFrame:
    """Rows whose close is at least ``threshold`` sample deviations from the mean of the last n closes, itself included."""
    rows = scored(bars, n, key, time).where(F.abs("z") >= threshold)
    return rows.select(key, time, "close", F.col("z").alias("zscore"), F.when(F.col("z") > 0, "HIGH").otherwise("LOW").alias("flag"))


def all_flags(bars: DataFrame, k: float = 1.5, fit_until: Column | None = None, key: str = KEY, time: str = TIME) -> DataFrame:
    """Every bar with both rules' results; the scored bars are stored once."""
    rows = stored(scored(bars, key=key, time=time), "scored-bars")
    return flagged(rows, fences(rows, k, fit_until, key, time), key=key)


def iqr_flags(bars: DataFrame, k: float = 1.5, fit_until: Column | None = None, key: str = KEY, time: str = TIME) -> DataFrame:
    """Rows whose percent return lies strictly outside the quartile fences of its series, with the z-score of the return.

    ``fit_until`` keeps later rows out of the fences.
    """
    rows = stored(scored(bars, key=key, time=time), "scored-bars").withColumn("z", F.lit(None).cast("double"))
    return flagged(rows, fences(rows, k, fit_until, key, time), key=key).where("by_fence").select(key, time, "close", "zscore", "flag")


def merged_flags(bars: DataFrame, key: str = KEY, time: str = TIME, **how) -> DataFrame:
    """Both detectors, one row per bar; the z-score row wins."""
    return all_flags(bars, key=key, time=time, **how).where("flag is not null").select(key, time, "close", "zscore", "flag")


def summary(flags: DataFrame, key: str = KEY, time: str = TIME) -> DataFrame:
    """Spikes, crashes, total, largest deviation and last time per series."""
    return flags.groupBy(key).agg(
        F.count_if(F.col("flag") == "HIGH").alias("spikes"),
        F.count_if(F.col("flag") == "LOW").alias("crashes"),
        F.count("*").alias("total"),
        F.max(F.abs("zscore")).alias("max_zscore"),
        F.max(time).alias("last_seen"),
    )
