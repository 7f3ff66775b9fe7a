"""Quantiles and moments over any span of periods, from small stored summaries that new periods are added to.

A summary row counts the values of a key that share a period and a cell.  Cells cut the number line at fixed
places, 64 to each power of two, so summaries of any periods add up.  The ranks of a span are found by counts
alone; of the stored values only those of the cells that hold a wanted rank are read.

Rows with a null period or a null value are not part of any span; a null key is a key of its own.  NaN is the
largest value, as Spark orders it, and infinite values have cells of their own.  A key without values has no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .lineage import stored
from .series import KEY

#: Cells to a power of two.
FINE = 64
#: A cell of at most so many values is put in order; a fuller one is cut into ``PARTS`` of equal width first.
ORDERED = 1 << 16
PARTS = 4096


def cell(value: Column) -> Column:
    """The number of a value's cell; it never falls as the value grows."""
    # ln reaches from -745 to 710, so the numbers of positive values stay above zero and below those of infinity
    size = (F.floor(F.ln(F.abs(value)) * (FINE / 0.6931471805599453)) + F.lit(1200 * FINE)).cast("long")
    sign = F.when(value < 0, -1).otherwise(1)
    far = F.lit(1 << 40)
    return F.when(F.isnan(value), 2 * far).when(F.abs(value) == float("inf"), sign * far).when(value == 0, F.lit(0).cast("long")).otherwise(sign * size)


def summaries(values: DataFrame) -> DataFrame:
    """``_k, _p, _c, n, low, high, mean, m2`` of values (``_k, _p, _c, _v``)."""
    return values.groupBy("_k", "_p", "_c").agg(
        F.count("*").alias("n"),
        F.min("_v").alias("low"),
        F.max("_v").alias("high"),
        F.avg("_v").alias("mean"),
        (F.var_pop("_v") * F.count("*")).alias("m2"),
    )


def add(rows: DataFrame, path: str, column: str, period: Column, key: str = KEY, files: int = 8) -> None:
    """Add whole periods to the store at ``path``; periods that it has already give way to the new ones, others are not read.

    ``period`` is a string, such as the day or month of a row; a period has its own folder with up to ``files`` files.
    """
    values = rows.select(F.col(key).alias("_k"), period.cast("string").alias("_p"), F.col(column).cast("double").alias("_v")).where("_p is not null and _v is not null")
    values = stored(values.withColumn("_c", cell(F.col("_v"))), "period-values")
    for part, name, order in ((values, "values", ["_k", "_c", "_v"]), (summaries(values), "summaries", ["_k", "_c"])):
        # a period of many rows is dealt out by cells; files are in order, so their statistics tell the cells apart
        part = part.repartition("_p", F.pmod(F.xxhash64("_k", "_c"), F.lit(files))).sortWithinPartitions("_p", *order)
        part.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_p").parquet(f"{path}/{name}")


def _read(spark: SparkSession, path: str, name: str, schema: str, first: str | None, last: str | None) -> DataFrame:
    rows = spark.read.schema(schema).parquet(f"{path}/{name}")
    rows = rows if first is None else rows.where(F.col("_p") >= first)
    return rows if last is None else rows.where(F.col("_p") <= last)


def span_summaries(spark: SparkSession, path: str, key: str, first: str | None = None, last: str | None = None) -> DataFrame:
    return _read(spark, path, "summaries", f"_k {key}, _c long, n long, low double, high double, mean double, m2 double, _p string", first, last)


def moments(summary: DataFrame, into: str = KEY) -> DataFrame:
    """``key, n, mean, sd`` (sample deviation; null for one value) from summaries alone."""
    whole = summary.groupBy(F.col("_k").alias("_wk")).agg(F.sum("n").alias("_n"), (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("_mean"))
    apart = summary.join(whole, F.col("_k").eqNullSafe(F.col("_wk")))
    off = F.col("mean") - F.col("_mean")
    out = apart.groupBy("_k", "_n", "_mean").agg(F.sum(F.col("m2") + F.col("n") * off * off).alias("_m2"))
    sd = F.when(F.col("_n") > 1, F.sqrt(F.col("_m2") / (F.col("_n") - 1)))
    return out.select(F.col("_k").alias(into), F.col("_n").alias("n"), F.col("_mean").alias("mean"), sd.alias("sd"))


def _holding(counts: DataFrame, within: list[str], order: str) -> DataFrame:
    """Of counted parts those that hold a wanted rank, with the number of values before them in ``before``."""
    upto = F.sum("n").over(Window.partitionBy(*within).orderBy(order))
    parts = counts.withColumn("before", F.col("before") + upto - F.col("n"))
    held = lambda r: (r >= F.col("before")) & (r < F.col("before") + F.col("n"))
    return parts.where(F.exists("ranks", held))


def quantiles(spark: SparkSession, path: str, shares: list[float], kind: str = "string", key: str = KEY, first: str | None = None, last: str | None = None, ordered: int = ORDERED) -> DataFrame:
    """``key, n, q``: exact quantiles, linear between neighbours, of the periods from ``first`` to ``last``, both included.

    ``kind`` is the type of the key.  The result is that of a percentile over all values of the span.
    """
    rank = lambda share: (F.col("total") - 1) * F.lit(float(share))
    summary = span_summaries(spark, path, kind, first, last)
    merged = summary.groupBy("_k", "_c").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
    whole = merged.groupBy(F.col("_k").alias("_wk")).agg(F.sum("n").alias("total"))
    wanted = F.array(*[f(rank(s)).cast("long") for s in shares for f in (F.floor, F.ceil)])
    cells = merged.join(whole.withColumn("ranks", wanted), F.col("_k").eqNullSafe(F.col("_wk"))).drop("_wk").withColumn("before", F.lit(0).cast("long"))
    held = stored(_holding(cells, ["_k"], "_c"), "held-cells")

    values = _read(spark, path, "values", f"_k {kind}, _v double, _c long, _p string", first, last).select("_k", "_c", "_v")
    numbers = [r[0] for r in held.where("low < high").select("_c").distinct().limit(1001).collect()]
    if len(numbers) <= 1000:  # few enough to be told to the scan; the join below keeps the same rows without it
        values = values.where(F.col("_c").isin(numbers))

    def inside(parts: DataFrame) -> DataFrame:
        parts = parts.where("low < high").select(F.col("_k").alias("_hk"), F.col("_c").alias("_hc"), "low", "high", "before", "total", "ranks")
        same = F.col("_k").eqNullSafe(F.col("_hk")) & (F.col("_c") == F.col("_hc"))
        return values.join(parts, same & (F.col("_v") >= F.col("low")) & (F.col("_v") <= F.col("high"))).drop("_hk", "_hc")

    # doubles of a cell are evenly spaced, so each round takes 12 of their 46 bits: at most four rounds
    while (held.where("low < high").agg(F.max("n")).first()[0] or 0) > ordered:
        share = (F.col("_v") - F.col("low")) / (F.col("high") - F.col("low"))
        part = F.least(F.floor(share * PARTS), F.lit(PARTS - 1)).alias("_part")
        counts = inside(held).groupBy("_k", "_c", F.col("low").alias("_low"), part, "before", "total", "ranks")
        counts = counts.agg(F.count("*").alias("n"), F.min("_v").alias("low"), F.max("_v").alias("high"))
        finer = _holding(counts, ["_k", "_c", "_low"], "_part").drop("_low", "_part")
        held = stored(finer.unionByName(held.where("low >= high")), "held-cells")

    each = inside(held).groupBy("_k", "_c", F.col("low").alias("_low"), "_v", "before", "total", "ranks").agg(F.count("*").alias("n"))
    exact = _holding(each, ["_k", "_c", "_low"], "_v").select("_k", "total", "ranks", "before", "n", "_v")
    exact = exact.unionByName(held.where("low >= high").select("_k", "total", "ranks", "before", "n", F.col("low").alias("_v")))
    at = lambda k: F.max(F.when((F.get("ranks", F.lit(k)) >= F.col("before")) & (F.get("ranks", F.lit(k)) < F.col("before") + F.col("n")), F.col("_v")))
    found = exact.groupBy("_k", "total").agg(*[at(k).alias(f"_q{k}") for k in range(2 * len(shares))])

    def between(i: int, share: float) -> Column:
        a, b = F.col(f"_q{2 * i}"), F.col(f"_q{2 * i + 1}")
        return F.when(a == b, a).otherwise(a + (rank(share) - F.floor(rank(share))) * (b - a))

    return found.select(F.col("_k").alias(key), F.col("total").alias("n"), F.array(*[between(i, s) for i, s in enumerate(shares)]).alias("q"))
