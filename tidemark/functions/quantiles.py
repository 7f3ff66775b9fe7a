"""Exact quantiles per key without a whole series in one buffer."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .series import KEY


def exact_quantiles(rows: DataFrame, column: str, shares: list[float], key: str = KEY, cells: int = 256) -> DataFrame:
    """``key, n, q``: the number of values that are not null, and their quantiles, linear between neighbours.

    A sketch of bounded size gives cell borders of about equal counts per key.  Cells are
    counted exactly, and values are ordered in those cells alone that hold a wanted
    rank, equal values as one.  ``rows`` is read three times; give a stored table.
    """
    rows = rows.select(F.col(key).alias("_k"), F.col(column).cast("double").alias("_v")).where("_v is not null")
    borders = rows.groupBy(F.col("_k").alias("_bk")).agg(F.count("*").alias("n"), F.percentile_approx("_v", [k / cells for k in range(1, cells)], 20 * cells).alias("_at"))
    rank = lambda share: (F.col("n") - 1) * F.lit(float(share))
    wanted = F.array(*[f(rank(s)).cast("long") for s in shares for f in (F.floor, F.ceil)])
    borders = borders.select("_bk", "n", F.array_distinct("_at").alias("_at"), wanted.alias("_ranks"))
    # the cell of a value: the number of borders below it
    cell = F.expr("case when array_position(_at, _v) > 0 then array_position(_at, _v) - 1 else size(filter(_at, b -> b < _v)) end")
    placed = rows.join(borders, F.col("_k").eqNullSafe(F.col("_bk"))).select("_k", "n", "_ranks", "_v", cell.alias("_c"))
    counts = placed.groupBy("_k", "_c").agg(F.count("*").alias("_n"), F.first("_ranks").alias("_ranks"))
    upto = F.sum("_n").over(Window.partitionBy("_k").orderBy("_c"))
    held = counts.select(F.col("_k").alias("_hk"), F.col("_c").alias("_hc"), (upto - F.col("_n")).alias("_before"), "_ranks", upto.alias("_upto"))
    held = held.where(F.exists("_ranks", lambda r: (r >= F.col("_before")) & (r < F.col("_upto")))).select("_hk", "_hc", "_before")
    inner = placed.join(held, F.col("_k").eqNullSafe(F.col("_hk")) & (F.col("_c") == F.col("_hc")))
    values = inner.groupBy("_k", "_c", "_v").agg(F.count("*").alias("_n"), F.first("_before").alias("_before"), F.first("n").alias("n"), F.first("_ranks").alias("_ranks"))
    last = F.col("_before") + F.sum("_n").over(Window.partitionBy("_k", "_c").orderBy("_v"))
    ranked = values.withColumn("_last", last).withColumn("_first", F.col("_last") - F.col("_n"))
    at = lambda k: F.max(F.when((F.get("_ranks", F.lit(k)) >= F.col("_first")) & (F.get("_ranks", F.lit(k)) < F.col("_last")), F.col("_v")))
    found = ranked.groupBy("_k", "n").agg(*[at(k).alias(f"_q{k}") for k in range(2 * len(shares))])
    between = [F.col(f"_q{2 * i}") + (rank(s) - F.floor(rank(s))) * (F.col(f"_q{2 * i + 1}") - F.col(f"_q{2 * i}")) for i, s in enumerate(shares)]
    return found.select(F.col("_k").alias(key), "n", F.array(*between).alias("q"))
