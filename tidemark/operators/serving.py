"""Serving queries over all tickers: latest rows, header figures, panels and rankings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.series import KEY
from .indicators import readings
from .sentiment import zone


def lookback(rows: DataFrame, time: str, as_of: Column, days: int) -> DataFrame:
    """Rows of the last days; ``as_of`` stands for now, so a query gives the same rows again."""
    return rows.where((F.col(time) >= as_of - F.make_dt_interval(F.lit(days))) & (F.col(time) <= as_of))


def latest(rows: DataFrame, n: int, time: str, ties: list[str] | None = None) -> DataFrame:
    """The last n rows of every ticker."""
    window = Window.partitionBy(KEY).orderBy(F.col(time).desc(), *(ties or []))
    return rows.withColumn("_n", F.row_number().over(window)).where(F.col("_n") <= n).drop("_n")


def latest_price(bars: DataFrame, time: str = "ds") -> DataFrame:
    """Last time and close of every ticker, by partial aggregates."""
    return bars.groupBy(KEY).agg(F.max(time).alias(time), F.max_by("close", time).alias("close"))


def price_change(bars: DataFrame, time: str = "ds") -> DataFrame:
    """Last bar against the one before: change and percent; null without one before.

    Only the last two bars of a ticker leave the task that reads them.
    """
    two = latest(bars.select(KEY, time, "close", "high", "low"), 2, time)
    ends = two.groupBy(KEY).agg(F.max_by(F.struct(time, "close", "high", "low"), time).alias("s"), F.min_by("close", time).alias("_first"), F.count("*").alias("_n"))
    rows = ends.select(KEY, "s.*", F.when(F.col("_n") == 2, F.col("_first")).alias("previous"))
    move = F.col("close") - F.col("previous")
    return rows.withColumns({"change": move, "change_pct": 100 * F.try_divide(move, "previous")})


def rows_per_source(rows: DataFrame) -> DataFrame:
    return rows.groupBy(KEY, "source").agg(F.count("*").alias("n_rows"))


def header(rows: DataFrame, sentiment: DataFrame, time: str = "ds") -> DataFrame:
    """One row per ticker from a flagged frame: close and change, RSI and its zone, number of anomalies, sentiment and its zone.

    The last bar and the number of flags come from one aggregate.
    """
    shown = ["close", "high", "low", F.col("close_lag_1").alias("previous"), "rsi_14", "macd", "macd_signal"]
    last = rows.groupBy(KEY).agg(F.max_by(F.struct(time, *shown), time).alias("s"), F.count("flag").alias("n_anomalies")).select(KEY, "s.*", "n_anomalies")
    move = F.col("close") - F.col("previous")
    last = readings(last.withColumns({"change": move, "change_pct": 100 * F.try_divide(move, "previous")}))
    known = lambda c, of: F.when(F.col(of).isNotNull(), F.col(c)).alias(c)
    mood = sentiment.select(KEY, "avg_compound", zone(F.col("avg_compound")).alias("sentiment_zone"))
    rows = last.join(mood, KEY, "left")
    return rows.select(KEY, time, "close", "high", "low", "previous", "change", "change_pct", "rsi_14", known("rsi_zone", "rsi_14"), known("macd_side", "macd"), "n_anomalies", "avg_compound", "sentiment_zone")


def price_panel(rows: DataFrame, as_of: Column, days: int, time: str = "ds") -> DataFrame:
    """Bars of the last days of a flagged frame with indicators and flags."""
    return lookback(rows, time, as_of, days).select(KEY, time, "open", "high", "low", "close", "volume", "rsi_14", "macd", "macd_signal", "bb_upper", "bb_middle", "bb_lower", "zscore", "flag")


def ranked(rows: DataFrame, by: str) -> DataFrame:
    """All rows from the largest value down; for the edge, not inside a plan."""
    return rows.orderBy(F.col(by).desc_nulls_last(), KEY)
