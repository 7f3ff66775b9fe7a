"""Exponential means, and all other look-backs, in blocks of a series.

The rows of a series are numbered and dealt into blocks of numbers; a block also
gets as many rows before it as its look-backs reach.  Every window is then over
(key, block), so a long series is many tasks, and any number of means, rolling
statistics and lags share one exchange and one sort.

The recurrence e_t = a*x_t + (1-a)*e_(t-1), e_0 = x_0, is a weighted running sum in a
block.  What lies further back than its reach is decayed below what a double holds.
"""

from __future__ import annotations

from math import ceil, log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .series import KEY, TIME, ordered

#: What is decayed below exp(-REACH) of a value is left out; a double holds about exp(-36).
REACH = 42
#: Weights inside a block stay below exp(SPAN); a double holds exp(709).
SPAN = 650
BLOCK = 2048


def reach(alpha: float) -> int:
    """How many rows back a mean reaches."""
    return ceil(REACH / -log(1 - alpha))


def deal(df: DataFrame, before: int, after: int = 0, alphas: tuple[float, ...] = (), index: str = "_i", block: int = BLOCK) -> DataFrame:
    """Deal numbered rows into blocks: adds ``_block``, ``_own`` (false in the copies for other blocks) and ``_e`` (place in the block).

    A row goes to every block from that of the row ``after`` rows before it to that of the row
    ``before`` rows behind it.  Rows without a number stay as they are.
    """
    if alphas:
        block = max(1, min(block, int(SPAN / -log(1 - max(alphas))) - before - after))
    number = F.col(index)
    first, last = (F.greatest(F.lit(0), number - after) / block), ((number + before) / block)
    to = F.sequence(F.floor(first), F.floor(last))
    rows = df.select("*", F.explode_outer(to).alias("_block"))
    own = F.col("_block").eqNullSafe(F.floor(number / block))
    return rows.withColumns({"_own": own, "_e": number - F.col("_block") * block + before})


def inside(key: str = KEY) -> list[str]:
    """The key of windows over dealt rows; they are ordered by the number."""
    return [key, "_block"]


def own(df: DataFrame) -> DataFrame:
    """The dealt rows once each, without the columns of the dealing."""
    return df.where("_own").drop("_block", "_own", "_e")


def mean(column: str | Column, alpha: float, first: int = 0, key: str = KEY, index: str = "_i") -> Column:
    """The exponential mean of a column of dealt rows that begins at number ``first``; null before."""
    column = F.col(column) if isinstance(column, str) else column
    q = 1 - alpha
    part = F.when(F.col(index) == first, column).when(F.col(index) > first, alpha * column)
    window = ordered(inside(key), index).rowsBetween(Window.unboundedPreceding, 0)
    # one base for both powers: their errors cancel
    summed = F.sum(part * F.pow(F.lit(q), -F.col("_e"))).over(window)
    return F.when(F.col(index) >= first, summed * F.pow(F.lit(q), "_e"))


def ewm(df: DataFrame, means: dict[str, tuple[str, float]], key: str = KEY, time: str = TIME, block: int = BLOCK, index: str | None = None) -> DataFrame:
    """Add one column per entry ``name: (column, alpha)``.

    All columns must be null in the same rows; such rows stay null and do not
    count, so a mean begins at the first value.  ``index`` names a column that
    already numbers the rows from 0 (see ``long_series``); values are then not null.
    """
    first = next(iter(means.values()))[0]
    names = df.columns
    number = F.col(index) if index else F.when(F.col(first).isNotNull(), F.count(first).over(ordered(key, time)) - 1)
    alphas = tuple(a for _, a in means.values())
    rows = deal(df.withColumn("_i", number), max(map(reach, alphas)), 0, alphas, block=block)
    return own(rows.withColumns({name: mean(column, alpha, key=key) for name, (column, alpha) in means.items()})).select(*names, *means)
