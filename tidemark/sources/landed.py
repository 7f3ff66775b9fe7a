"""Landed files and payloads to canonical bars and headlines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_POINT = "struct<`1. open`:string,`2. high`:string,`3. low`:string,`4. close`:string,`5. volume`:string>"


def series_bars(payloads: DataFrame, series: str, zone: str, interval: str, source: str) -> tuple[DataFrame, DataFrame]:
    """Nested time-series JSON (``ticker, payload``) to bars, and the payloads without the series with their notice.

    ``zone`` is the zone of the time keys.  Numbers that cannot be read become
    null; rows without a close are dropped.  A payload that is no JSON and one that lacks the series have different notices.
    """
    kind = f"struct<`{series}`:map<string,{_POINT}>,`Note`:string,`Information`:string>"
    read = payloads.select("ticker", "payload", F.from_json("payload", kind).alias("p"))
    points = read.where(F.col(f"p.`{series}`").isNotNull()).select("ticker", F.explode(f"p.`{series}`").alias("at", "v"))
    number = lambda name, to: F.col(f"v.`{name}`").try_cast(to)
    bars = points.select(
        "ticker",
        F.lit(source).alias("source"),
        F.lit(interval).alias("interval"),
        F.to_utc_timestamp(F.try_to_timestamp("at"), zone).alias("ts"),
        number("1. open", "double").alias("open"),
        number("2. high", "double").alias("high"),
        number("3. low", "double").alias("low"),
        number("4. close", "double").alias("close"),
        number("5. volume", "long").alias("volume"),
    )
    unread = F.when(F.expr("try_parse_json(payload) is null"), "not JSON").otherwise("no series")
    rejects = read.where(F.col(f"p.`{series}`").isNull()).select("ticker", F.coalesce("p.Note", "p.Information", unread).alias("reason"))
    return bars.where("close is not null and ts is not null"), rejects


def wide_bars(frame: DataFrame, ticker: Column | str, source: str, interval: str) -> DataFrame:
    """Wide bar files with headers of any case (``Date`` or ``Datetime``, ``Open``, …) to bars without null closes."""
    frame = frame.toDF(*[c.strip().lower() for c in frame.columns])
    at = "datetime" if "datetime" in frame.columns else "date"
    ticker = F.lit(ticker) if isinstance(ticker, str) else ticker
    return frame.select(
        ticker.alias("ticker"), F.lit(source).alias("source"), F.lit(interval).alias("interval"), F.col(at).cast("timestamp").alias("ts"),
        *[F.col(c).cast("double").alias(c) for c in ("open", "high", "low", "close")], F.col("volume").cast("long").alias("volume"),
    ).dropna(subset=["close"])


def read_wide_csv(spark: SparkSession, path: str, ticker: Column | str, source: str, interval: str) -> DataFrame:
    return wide_bars(spark.read.option("header", True).csv(path), ticker, source, interval)


# The zone names of RFC 822 and their hours; any other name counts as UTC.
ZONES = {"EST": -5, "EDT": -4, "CST": -6, "CDT": -5, "MST": -7, "MDT": -6, "PST": -8, "PDT": -7}


def feed_time(text: Column) -> Column:
    """The time of an RFC 822 date in UTC: with or without weekday and seconds, any numeric or named zone; null if it cannot be read."""
    body = F.regexp_replace(F.trim(text), r"^[A-Za-z]+,?\s*", "")
    local = F.try_to_timestamp(F.regexp_extract(body, r"^(\d{1,2} [A-Za-z]{3} \d{4} \d{2}:\d{2}(:\d{2})?)", 1), F.lit("d MMM yyyy HH:mm[:ss]"))
    zone = F.regexp_extract(body, r"([A-Za-z]+|[+-]\d{2}:?\d{2})$", 1)
    sign = F.when(F.left(zone, F.lit(1)) == "-", -1).otherwise(1)
    digits = F.regexp_replace(zone, "[^0-9]", "")
    minutes = F.when(F.length(digits) == 4, sign * (60 * F.left(digits, F.lit(2)).try_cast("int") + F.right(digits, F.lit(2)).try_cast("int")))
    for name, hours in ZONES.items():
        minutes = F.when(F.upper(zone) == name, F.lit(60 * hours)).otherwise(minutes)
    return local - F.make_dt_interval(F.lit(0), F.lit(0), F.coalesce(minutes, F.lit(0)))


def rss_headlines(items: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """Feed items (``ticker, title, link, pubDate``) of the last days; an item without a readable date keeps a null one."""
    rows = items.select("ticker", F.lit("rss").alias("source"), feed_time(F.col("pubDate")).alias("published_at"), F.trim("title").alias("headline"), F.col("link").alias("url"))
    fresh = F.col("published_at").isNull() | (F.col("published_at") >= as_of - F.make_dt_interval(F.lit(days)))
    return rows.where((F.length("headline") > 0) & fresh)


def rss_items(documents: DataFrame) -> DataFrame:
    """RSS documents (``ticker, xml``) to items."""
    kind = "channel struct<item:array<struct<title:string,link:string,pubDate:string>>>"
    read = documents.select("ticker", F.from_xml("xml", kind).alias("x"))
    return read.select("ticker", F.explode("x.channel.item").alias("i")).select("ticker", "i.title", "i.link", "i.pubDate")


def news_headlines(payloads: DataFrame, as_of: Column, days: int = 7, newest: int = 20) -> DataFrame:
    """News JSON (``ticker, payload``) to the newest headlines of the last days of each ticker; empty and removed titles are dropped."""
    from pyspark.sql import Window

    kind = "struct<articles:array<struct<title:string,url:string,publishedAt:string>>>"
    rows = payloads.select("ticker", F.explode(F.from_json("payload", kind)["articles"]).alias("a"))
    rows = rows.select("ticker", F.lit("newsapi").alias("source"), F.try_to_timestamp("a.publishedAt").alias("published_at"), F.trim("a.title").alias("headline"), F.col("a.url").alias("url"))
    rows = rows.where((F.length("headline") > 0) & (F.col("headline") != "[Removed]"))
    rows = rows.where(F.col("published_at").isNull() | (F.col("published_at") >= as_of - F.make_dt_interval(F.lit(days))))
    order = Window.partitionBy("ticker").orderBy(F.col("published_at").desc_nulls_last(), "headline")
    return rows.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= newest).drop("_n")


def clean_tickers(text: Column) -> Column:
    """A comma-separated list of tickers as an array: trimmed, upper case, no blanks."""
    return F.filter(F.transform(F.split(text, ","), lambda t: F.upper(F.trim(t))), lambda t: F.length(t) > 0)
