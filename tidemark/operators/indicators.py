"""Technical indicators of all series in one plan: rows numbered once, one pass over blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.long_series import dealt
from ..functions.recurrence import inside, mean, own, reach
from ..functions.series import GATES, KEY, TIME, lag, rolling

WARM_UP = GATES["indicators"]


def look_back(n: int = 14, slow: int = 26, signal: int = 9) -> int:
    """Rows before a block that all indicators of its rows depend on: a mean of means reaches as far as both."""
    return max(reach(1 / n), reach(2 / (slow + 1)) + reach(2 / (signal + 1)))


def with_bands(rows: DataFrame, n: int = 20, width: float = 2.0, key: str = KEY) -> DataFrame:
    """Dealt rows with bands of ``width`` population deviations around the mean of n closes."""
    middle = rolling(F.avg, "close", n, inside(key), "_i")
    spread = width * rolling(F.stddev_pop, "close", n, inside(key), "_i")
    return rows.withColumns({"bb_middle": middle, "bb_upper": middle + spread, "bb_lower": middle - spread})


def with_macd(rows: DataFrame, fast: int = 12, slow: int = 26, signal: int = 9, key: str = KEY) -> DataFrame:
    """Dealt rows with the MACD line from row ``slow`` on, its signal after ``signal`` values, and their difference."""
    line = mean("close", 2 / (fast + 1), key=key) - mean("close", 2 / (slow + 1), key=key)
    rows = rows.withColumn("macd", F.when(F.col("_i") >= slow - 1, line))
    rows = rows.withColumn("macd_signal", F.when(F.col("_i") >= slow + signal - 2, mean("macd", 2 / (signal + 1), slow - 1, key)))
    return rows.withColumn("macd_hist", F.col("macd") - F.col("macd_signal"))


def with_rsi(rows: DataFrame, n: int = 14, key: str = KEY) -> DataFrame:
    """Dealt rows with the relative strength index: Wilder means; 100 where the mean loss is zero; the first row counts as no move."""
    move = F.coalesce(F.col("close") - lag("close", 1, inside(key), "_i"), F.lit(0.0))
    move = F.when(F.col("_i") == 0, F.lit(0.0)).otherwise(move)
    rows = rows.withColumns({"_up": F.greatest(move, F.lit(0.0)), "_down": F.greatest(-move, F.lit(0.0))})
    rows = rows.withColumns({"_gain": mean("_up", 1 / n, key=key), "_loss": mean("_down", 1 / n, key=key)})
    value = F.when(F.col("_loss") == 0, F.lit(100.0)).otherwise(100 - F.try_divide(F.lit(100.0), 1 + F.try_divide("_gain", "_loss")))
    return rows.withColumn(f"rsi_{n}", F.when(F.col("_i") >= n - 1, value)).drop("_up", "_down", "_gain", "_loss")


def bollinger(bars: DataFrame, n: int = 20, width: float = 2.0, key: str = KEY, time: str = TIME) -> DataFrame:
    return own(with_bands(dealt(bars, n - 1, key=key, time=time), n, width, key)).drop("_i")


def macd(bars: DataFrame, fast: int = 12, slow: int = 26, signal: int = 9, key: str = KEY, time: str = TIME) -> DataFrame:
    alphas = tuple(2 / (n + 1) for n in (fast, slow, signal))
    return own(with_macd(dealt(bars, look_back(2, slow, signal), 0, alphas, key=key, time=time), fast, slow, signal, key)).drop("_i")


def rsi(bars: DataFrame, n: int = 14, key: str = KEY, time: str = TIME) -> DataFrame:
    return own(with_rsi(dealt(bars, reach(1 / n) + 1, 0, (1 / n,), key=key, time=time), n, key)).drop("_i")


#: The fastest mean of the standard set; it bounds the length of a block.
ALPHAS = (2 / 10,)


def with_indicators(rows: DataFrame, key: str = KEY) -> DataFrame:
    """Dealt rows with RSI(14), MACD(12, 26, 9) and Bollinger(20, 2)."""
    return with_bands(with_macd(with_rsi(rows, 14, key), 12, 26, 9, key), 20, 2.0, key)


def indicators(bars: DataFrame, warm_up: int = WARM_UP, key: str = KEY, time: str = TIME) -> DataFrame:
    """RSI(14), MACD(12, 26, 9) and Bollinger(20, 2); the first ``warm_up`` - 1 rows of a series are left out, so a series with fewer rows is too."""
    rows = own(with_indicators(dealt(bars, look_back() + 1, 0, ALPHAS, key=key, time=time), key))
    return rows.where((F.col("_i") >= warm_up - 1) & F.col("rsi_14").isNotNull() & F.col("macd").isNotNull() & F.col("bb_upper").isNotNull()).drop("_i")


def readings(rows: DataFrame) -> DataFrame:
    """Labels of indicator rows: RSI zone and MACD direction."""
    zone = F.when(F.col("rsi_14") > 70, "OVERBOUGHT").when(F.col("rsi_14") < 30, "OVERSOLD").otherwise("NEUTRAL")
    return rows.withColumns({"rsi_zone": zone, "macd_side": F.when(F.col("macd") > F.col("macd_signal"), "BULLISH").otherwise("BEARISH")})
