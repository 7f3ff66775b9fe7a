"""Ordered-window functions over many keyed series.

All use one window, (key, time), so that consecutive functions share one exchange
and one sort.  Rolling statistics are null until their window is full.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY, TIME = "ticker", "ts"


def ordered(key: str = KEY, time: str = TIME):
    return Window.partitionBy(key).orderBy(time)


def trailing(n: int, key: str = KEY, time: str = TIME):
    """The current row and the n - 1 rows before it."""
    return ordered(key, time).rowsBetween(1 - n, 0)


def rolling(aggregate, column: str | Column, n: int, key: str = KEY, time: str = TIME) -> Column:
    """``aggregate`` over the last n rows; null unless all n values are there."""
    window = trailing(n, key, time)
    column = F.col(column) if isinstance(column, str) else column
    return F.when(F.count(column).over(window) == n, aggregate(column).over(window))


def lag(column: str, n: int = 1, key: str = KEY, time: str = TIME) -> Column:
    return F.lag(column, n).over(ordered(key, time))


def change(column: str, n: int = 1, key: str = KEY, time: str = TIME) -> Column:
    """Relative change over n rows; null where the earlier value is zero or missing."""
    before = lag(column, n, key, time)
    return F.try_divide(F.col(column) - before, before)


def position(key: str = KEY, time: str = TIME, last: bool = False) -> Column:
    """1 for the first row of a series, or for the last one."""
    window = Window.partitionBy(key).orderBy(F.col(time).desc() if last else F.col(time))
    return F.row_number().over(window)


def _lengths(df: DataFrame, key: str | list[str]) -> DataFrame:
    return df.groupBy(*([key] if isinstance(key, str) else key)).agg(F.count("*").alias("n_rows"))


def long_enough(df: DataFrame, rows: int, key: str = KEY) -> DataFrame:
    """Only series with at least ``rows`` rows."""
    enough = _lengths(df, key).where(F.col("n_rows") >= rows).select(F.col(key).alias("_long"))
    return df.join(enough, F.col(key).eqNullSafe(F.col("_long")), "left_semi")


def too_short(df: DataFrame, rows: int, key: str | list[str] = KEY) -> DataFrame:
    """The series that :func:`long_enough` leaves out, with their lengths."""
    return _lengths(df, key).where(F.col("n_rows") < rows).withColumn("needed", F.lit(rows).cast("long"))


#: The rows that a series needs for each stage; a shorter one is skipped there.
GATES = {"indicators": 26, "zscore": 30, "forecast": 60, "trees": 60, "stack": 90}


def skipped(df: DataFrame, key: str | list[str] = KEY) -> DataFrame:
    """Series and stages that their length rules out: ``key, stage, n_rows, needed``."""
    gates = F.array(*[F.struct(F.lit(s).alias("stage"), F.lit(n).cast("long").alias("needed")) for s, n in GATES.items()])
    rows = _lengths(df, key).select("*", F.inline(gates))
    return rows.where(F.col("n_rows") < F.col("needed"))


def business_days(day: str | Column, n: int) -> Column:
    """The next n days from Monday to Friday after ``day``, as an array."""
    day = F.col(day) if isinstance(day, str) else day
    ahead = F.sequence(F.date_add(day, 1), F.date_add(day, 7 * (n // 5 + 2)))
    return F.slice(F.filter(ahead, lambda d: ~F.dayofweek(d).isin(1, 7)), 1, n)
