"""The given tables, and bars, headlines and forecasts that Spark derives from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import utc

TICKERS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return utc(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` dealt out to all cores, whatever their files and row groups: a file of one row group is one task, and the work on a text far outweighs its move."""
    docs = table(spark, sf_dir, "documents")
    return docs.repartition(max(docs.rdd.getNumPartitions(), spark.sparkContext.defaultParallelism))


def daily_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars from ``orders``: ticker = priority, price = total price, open and close by order key."""
    orders = table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderdate", "o_totalprice", "o_orderkey")
    return bars_from_ticks(
        orders.select(
            F.col("o_orderpriority").alias("ticker"), F.to_date("o_orderdate").alias("ds"), F.col("o_totalprice").alias("price"), F.col("o_orderkey").alias("seq")
        ),
        ["ticker", "ds"],
    )


def bars_from_ticks(ticks: DataFrame, keys: list) -> DataFrame:
    """Open, high, low, close and count of ``price`` in the order of ``seq``, per key."""
    return ticks.groupBy(*keys).agg(
        F.min_by("price", "seq").alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", "seq").alias("close"),
        F.count("*").alias("volume"),
    )


def ticks(events: DataFrame) -> DataFrame:
    """``ticker, ts, price, seq`` from events."""
    return events.select(F.col("event_type").alias("ticker"), "ts", F.col("value").alias("price"), F.col("event_id").alias("seq"))


def intraday_bars(spark: SparkSession, sf_dir: str, width: str = "15 minutes") -> DataFrame:
    bars = bars_from_ticks(ticks(table(spark, sf_dir, "events")), ["ticker", F.window("ts", width).alias("w")])
    return bars.select("ticker", F.col("w.start").alias("ts"), "open", "high", "low", "close", "volume")


def headlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headlines from ``documents``, whole texts: ticker and time follow from the id; both are null without one."""
    docs = texts(spark, sf_dir)
    names = F.array(*map(F.lit, TICKERS))
    at = F.lit("1995-01-01").cast("timestamp") + F.make_dt_interval(F.col("doc_id") % 200, F.lit(0), F.lit(0), (F.col("doc_id") % 86400).cast("decimal(18,6)"))
    return docs.select(F.get(names, (F.col("doc_id") % 5).cast("int")).alias("ticker"), "source", at.alias("published_at"), F.col("text").alias("headline"))


def stand_in_forecasts(bars: DataFrame) -> DataFrame:
    """Two runs of four stand-in models m1 … m4, the close 1 … 4 bars ago with bounds of 2 %; the second run is 1 % higher."""
    from ..functions.series import lag

    wide = bars.select("ticker", "ds", *[lag("close", k, time="ds").alias(f"m{k}") for k in range(1, 5)])
    long = wide.unpivot(["ticker", "ds"], ["m1", "m2", "m3", "m4"], "model", "predicted").where("predicted is not null")
    runs = F.array(F.struct(F.lit("2024-01-01").cast("timestamp").alias("run_at"), F.lit(1.0).alias("f")), F.struct(F.lit("2024-01-02").cast("timestamp").alias("run_at"), F.lit(1.01).alias("f")))
    out = long.withColumn("r", F.explode(runs)).withColumn("p", F.col("predicted") * F.col("r.f"))
    return out.select("ticker", "model", F.col("ds").alias("forecast_date"), F.col("p").alias("predicted_close"), (F.col("p") * 0.98).alias("lower_bound"), (F.col("p") * 1.02).alias("upper_bound"), "r.run_at")
