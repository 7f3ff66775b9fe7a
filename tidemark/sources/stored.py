"""Stored bars and the ticker dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DIMENSION = "ticker string, keyword string, feeds array<string>"


def stored_bars(spark: SparkSession, path: str, source: str, interval: str = "1d") -> DataFrame:
    """Bars of one source and one grain as doubles; both filters reach the files.

    Daily and intraday bars of a source share a table, so every operator works
    on one declared grain.
    """
    rows = spark.read.parquet(path).where((F.col("source") == source) & (F.col("interval") == interval))
    prices = [F.col(c).cast("double").alias(c) for c in ("open", "high", "low", "close")]
    return rows.select("ticker", "source", "interval", "ts", *prices, F.col("volume").cast("long").alias("volume"))


def dimension(spark: SparkSession, rows: list[tuple[str, str, list[str]]]) -> DataFrame:
    """Search keyword and feeds of each ticker; one row a ticker, as listed by the caller."""
    return spark.createDataFrame(rows, DIMENSION)


def with_keyword(headlines: DataFrame, tickers: DataFrame) -> DataFrame:
    """Headlines with their ticker's keyword and number of feeds; the dimension is a short list held by the driver, so it is broadcast."""
    side = tickers.select("ticker", "keyword", F.size("feeds").alias("n_feeds"))
    return headlines.join(F.broadcast(side), "ticker", "left")
