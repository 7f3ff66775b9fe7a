"""Forecast tables: errors, runs, pivots and comparisons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def errors(predictions: DataFrame, ids: list[str], actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """Root mean square, mean absolute and mean absolute percentage error, and rows, per key."""
    e = F.col(actual) - F.col(predicted)
    return predictions.groupBy(*ids).agg(
        F.count("*").alias("n"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(F.abs(e)).alias("mae"),
        (100 * F.avg(F.abs(F.try_divide(e, actual)))).alias("mape"),
    )


def averaged(forecasts: DataFrame) -> DataFrame:
    """Means over all runs per ticker, model and date."""
    values = ["predicted_close", "lower_bound", "upper_bound"]
    return forecasts.groupBy("ticker", "model", "forecast_date").agg(*[F.avg(c).alias(c) for c in values])


def latest_run(forecasts: DataFrame) -> DataFrame:
    """Of each ticker, model and date the row of the last run."""
    window = Window.partitionBy("ticker", "model", "forecast_date").orderBy(F.col("run_at").desc())
    return forecasts.withColumn("_n", F.row_number().over(window)).where("_n = 1").drop("_n")


def pivoted(forecasts: DataFrame, models: list[str], complete: bool = False) -> DataFrame:
    """One column per model and date of the last run; ``complete`` keeps dates that all models have."""
    wide = latest_run(forecasts.where(F.col("model").isin(models))).groupBy("ticker", "forecast_date").pivot("model", models).agg(F.max("predicted_close"))
    return wide.dropna(subset=models) if complete else wide


def comparison(scores: DataFrame, ensemble: str = "ensemble") -> DataFrame:
    """Errors per ticker and model, with the rank by MAPE and what the ensemble gains on the best other model."""
    others = scores.where(F.col("model") != ensemble).groupBy("ticker").agg(F.min("mape").alias("best_base"))
    rank = F.rank().over(Window.partitionBy("ticker").orderBy("mape")).cast("long")
    rows = scores.withColumn("rank", rank).join(others, "ticker", "left")
    gain = F.when(F.col("model") == ensemble, 100 * F.try_divide(F.col("best_base") - F.col("mape"), "best_base"))
    return rows.withColumn("improvement_pct", gain)


def top_features(importances: DataFrame, n: int = 5) -> DataFrame:
    window = Window.partitionBy("model").orderBy(F.col("importance").desc(), "feature")
    return importances.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= n)


def percent(value: Column, digits: int = 2) -> Column:
    """A signed percentage as text."""
    return F.format_string(f"%+.{digits}f%%", value)
