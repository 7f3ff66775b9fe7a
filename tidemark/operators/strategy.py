"""Evaluation of trading signals over many series and models at once.

Curves are an associative scan.  The rows of a series are numbered by counts per month and cut into blocks of ``BLOCK``; a block is
summed up in its product, its highest value and its last signal; what comes before a block is a window over these summaries,
one row a block; and inside a block running products and maxima start from there.  No task holds a whole series.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.long_series import month, numbered

DAYS_A_YEAR, RISK_FREE = 252, 0.045
IDS = ["ticker", "model"]
BLOCK = 4096


def _inside():
    """The rows of a block, in order."""
    return Window.partitionBy(*IDS, "_b").orderBy("_i")


def _up_to():
    """Those up to the present one."""
    return _inside().rowsBetween(Window.unboundedPreceding, 0)


def _earlier():
    """The blocks before one."""
    return Window.partitionBy(*IDS).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)


def _blocks(rows: DataFrame, time: str) -> DataFrame:
    """Number the rows of each series (``_i``) and cut them into blocks (``_b``)."""
    names = rows.columns
    rows = numbered(rows.withColumn("_series", F.struct(*IDS)), month(time), key="_series", time=time)
    return rows.select(*names, "_i", F.expr(f"_i div {BLOCK}").alias("_b"))


def _carried(rows: DataFrame, summaries: dict[str, Column], carries: dict[str, Column]) -> DataFrame:
    """``rows`` with what the blocks before theirs add up to: ``summaries`` of each block, ``carries`` over them."""
    found = rows.groupBy(*IDS, "_b").agg(*[v.alias(c) for c, v in summaries.items()])
    found = found.select(*[F.col(c).alias(f"_id_{c}") for c in [*IDS, "_b"]], *[v.alias(c) for c, v in carries.items()])
    same = [F.col(c).eqNullSafe(F.col(f"_id_{c}")) for c in [*IDS, "_b"]]
    return rows.join(found, same[0] & same[1] & same[2]).select(*[rows[c] for c in rows.columns], *carries)


def _product(before: Column, inside: Column) -> Column:
    """The product of both, of one where the other is missing, null without either."""
    return F.when(before.isNotNull() | inside.isNotNull(), F.coalesce(before, F.lit(1.0)) * F.coalesce(inside, F.lit(1.0)))


def signals(predictions: DataFrame, cost: float = 0.001, time: str = "ds") -> DataFrame:
    """From ``ticker, model, ds, previous, actual, predicted``: long if the prediction is above the previous close.

    A change from flat to long pays ``cost`` once.
    """
    return _signals(_blocks(predictions, time), cost).drop("_i", "_b")


def _signals(rows: DataFrame, cost: float) -> DataFrame:
    rows = rows.withColumn("signal", (F.col("predicted") > F.col("previous")).cast("int"))
    rows = rows.withColumn("day_return", F.try_divide(F.col("actual") - F.col("previous"), "previous"))
    names = rows.columns
    last = {"_last": F.max_by(F.struct("signal"), "_i")}
    rows = _carried(rows, last, {"_before": F.lag(F.col("_last")["signal"]).over(Window.partitionBy(*IDS).orderBy("_b"))})
    previous = F.when(F.row_number().over(_inside()) == 1, F.col("_before")).otherwise(F.lag("signal").over(_inside()))
    entry = ((F.col("signal") == 1) & (F.coalesce(previous, F.lit(0)) == 0)).cast("int")
    rows = rows.withColumn("entry", entry).select(*names, "entry")
    return rows.withColumn("strategy_return", F.col("signal") * F.col("day_return") - F.col("entry") * F.lit(cost))


def equity(rows: DataFrame, capital: float = 10_000.0, time: str = "ds") -> DataFrame:
    """Value of strategy and buy-and-hold after each day; day 0 is the capital."""
    return _equity(_blocks(rows, time), capital, time)


def _equity(rows: DataFrame, capital: float, time: str) -> DataFrame:
    grown = {"value": F.product(1 + F.col("strategy_return")), "benchmark": F.product(1 + F.col("day_return"))}
    carries = {f"_{c}": F.product(f"_all_{c}").over(_earlier()) for c in grown}
    found = _carried(rows, {f"_all_{c}": v for c, v in grown.items()}, carries)
    values = [(capital * _product(F.col(f"_{c}"), v.over(_up_to()))).alias(c) for c, v in grown.items()]
    days = found.select(*IDS, (F.col("_i") + 1).cast("int").alias("day"), time, *values)
    start = rows.select(*IDS).distinct().select(*IDS, F.lit(0).alias("day"), F.lit(None).cast(rows.schema[time].dataType).alias(time), F.lit(capital).alias("value"), F.lit(capital).alias("benchmark"))
    return start.unionByName(days)


def drawdowns(curve: DataFrame) -> DataFrame:
    """Deepest fall from a running maximum, per series and model (at most 0)."""
    rows = curve.select(*IDS, F.col("day").alias("_i"), F.expr(f"day div {BLOCK}").alias("_b"), "value")
    rows = _carried(rows, {"_top": F.max("value")}, {"_before": F.max("_top").over(_earlier())})
    peak = F.greatest("_before", F.max("value").over(_up_to()))
    return rows.select(*IDS, F.try_divide(F.col("value") - peak, peak).alias("d")).groupBy(*IDS).agg(F.min("d").alias("max_drawdown"))


def metrics(predictions: DataFrame, capital: float = 10_000.0, cost: float = 0.001, time: str = "ds") -> DataFrame:
    """Returns, Sharpe ratio, drawdown, win rate, trades and alpha, per series and model."""
    rows = _signals(_blocks(predictions, time), cost)
    curve = _equity(rows, capital, time)
    annual = lambda total: F.pow(1 + total, DAYS_A_YEAR / F.col("holdout_days")) - 1
    excess = F.col("strategy_return") - RISK_FREE / DAYS_A_YEAR
    long = F.col("signal") == 1
    out = rows.groupBy(*IDS).agg(
        F.count("*").alias("holdout_days"),
        (F.product(1 + F.col("strategy_return")) - 1).alias("total_return"),
        (F.product(1 + F.col("day_return")) - 1).alias("benchmark_return"),
        F.coalesce(F.try_divide(F.avg(excess), F.stddev_pop(excess)) * F.sqrt(F.lit(float(DAYS_A_YEAR))), F.lit(0.0)).alias("sharpe_ratio"),
        F.coalesce(F.try_divide(F.count_if(long & (F.col("day_return") > 0)).cast("double"), F.count_if(long)), F.lit(0.0)).alias("win_rate"),
        F.sum("entry").alias("num_trades"),
        F.stddev_pop("strategy_return").alias("_sd"),
    )
    out = out.withColumn("sharpe_ratio", F.when(F.col("_sd") == 0, 0.0).otherwise(F.col("sharpe_ratio"))).drop("_sd")
    out = out.withColumns({"annualized_return": annual(F.col("total_return")), "benchmark_annualized": annual(F.col("benchmark_return"))})
    out = out.withColumn("alpha", F.col("annualized_return") - F.col("benchmark_annualized"))
    return out.join(drawdowns(curve), IDS).withColumn("final_value", capital * (1 + F.col("total_return")))


def series_json(curve: DataFrame) -> DataFrame:
    """The curves of each series and model as JSON arrays, in day order."""
    days = F.sort_array(F.collect_list(F.struct("day", "value", "benchmark")))
    rows = curve.groupBy(*IDS).agg(days.alias("d"))
    return rows.select(*IDS, F.to_json("d.value").alias("daily_values"), F.to_json("d.benchmark").alias("benchmark_values"))


def series_rows(stored: DataFrame) -> DataFrame:
    """Rows of day and values from JSON arrays."""
    read = lambda c: F.from_json(c, "array<double>")
    rows = stored.select(*IDS, F.posexplode(F.arrays_zip(read("daily_values").alias("v"), read("benchmark_values").alias("b"))).alias("day", "z"))
    return rows.select(*IDS, "day", F.col("z.v").alias("value"), F.col("z.b").alias("benchmark"))
