"""Window functions for series too long for one task.

Rows are numbered within (key, bucket of time) and each bucket's first number
comes from a small table of counts, so no task sorts a whole series.  With
numbers, a fixed frame of n rows is a window over (key, block of numbers), see
``recurrence``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .recurrence import deal, inside, own
from .series import KEY, TIME, rolling


def numbered(df: DataFrame, bucket: Column, into: str = "_i", key: str = KEY, time: str = TIME, ties: tuple[str, ...] = ()) -> DataFrame:
    """Add the number of each row in its series, from 0, in the order of ``time`` and ``ties``.

    ``bucket`` never falls as time goes on, such as the day of ``time``.
    """
    names = df.columns
    rows = df.withColumn("_bucket", bucket)
    inside = F.row_number().over(Window.partitionBy(key, "_bucket").orderBy(time, *ties)) - 1
    counts = rows.groupBy(F.col(key).alias("_k"), F.col("_bucket").alias("_b")).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("_k", "_b", F.coalesce(before, F.lit(0)).alias("_start"))
    joined = rows.withColumn("_in", inside).join(starts, F.col(key).eqNullSafe(F.col("_k")) & F.col("_bucket").eqNullSafe(F.col("_b")))
    return joined.select(*[F.col(c) for c in names], (F.col("_start") + F.col("_in")).cast("long").alias(into))


def rolling_blocks(df: DataFrame, columns: dict[str, tuple], n: int, index: str = "_i", key: str = KEY, block: int = 100_000) -> DataFrame:
    """Add ``name: (aggregate, column)`` over the last n rows of numbered series; null until n values are there."""
    if n - 1 > block:
        raise ValueError("a block must hold the rows before it that a frame needs")
    names = df.columns
    rows = deal(df, n - 1, index=index, block=block)
    return own(rows.withColumns({name: rolling(aggregate, column, n, inside(key), index) for name, (aggregate, column) in columns.items()})).select(*names, *columns)


def from_end(rows: DataFrame, n: int, into: str = "_back", key: str = KEY, time: str = TIME) -> DataFrame:
    """Number the last n rows of each series from 1, the last one; null before them and in rows without a time.

    Rows of equal time share a number.  Each task keeps the last n times of its rows, so no task holds a whole series.
    """
    newest = Window.partitionBy(key).orderBy(F.col(time).desc())
    ends = rows.select(key, time).where(F.col(time).isNotNull()).withColumn("_n", F.row_number().over(newest)).where(F.col("_n") <= n)
    ends = ends.groupBy(F.col(key).alias("_k")).agg(F.sort_array(F.collect_list(time), asc=False).alias("_times"))
    at = F.nullif(F.array_position("_times", F.col(time)), F.lit(0)).cast("int")
    return rows.join(ends, F.col(key).eqNullSafe(F.col("_k")), "left").withColumn(into, at).drop("_k", "_times")


def month(time: str) -> Column:
    return F.date_trunc("month", F.col(time))


def dealt(df: DataFrame, before: int, after: int = 0, alphas: tuple[float, ...] = (), bucket: Column | None = None, key: str = KEY, time: str = TIME, ties: tuple[str, ...] = ()) -> DataFrame:
    """Rows numbered (``_i``) and dealt into blocks; ``bucket`` defaults to the month of ``time``."""
    return deal(numbered(df, month(time) if bucket is None else bucket, "_i", key, time, ties), before, after, alphas)
