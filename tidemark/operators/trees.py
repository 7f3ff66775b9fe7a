"""A random forest: one pooled fit over all series on relative features; boosted trees are in :mod:`boosting`."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.long_series import from_end
from ..functions.series import KEY
from .features import FEATURES

PRICES = [f for f in FEATURES if f.startswith(("close_lag", "rolling_mean")) or f in ("open", "high", "low")]
SPREADS = [f for f in FEATURES if f.startswith("rolling_std") or f in ("hl_range", "macd", "macd_signal", "macd_hist")]


def relative(rows: DataFrame) -> DataFrame:
    """Price features relative to the close, so that series of any level share one model; nulls become 0."""
    out = {c: F.try_divide(F.col(c), "close") - 1 for c in PRICES} | {c: F.try_divide(F.col(c), "close") for c in SPREADS}
    rows = rows.withColumns(out).withColumn("volume", F.log1p("volume"))
    rows = rows.withColumn("label", F.try_divide(F.col("target_next_close"), "close") - 1) if "target_next_close" in rows.columns else rows
    return rows.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in FEATURES})


def learner(kind: str, rounds: int = 300, seed: int = 42):
    """``forest``: a random forest with the library's defaults for drawing rows."""
    if kind != "forest":
        raise ValueError(f"unknown kind {kind!r}; boosted trees are in boosting")
    return RandomForestRegressor(
        numTrees=rounds, maxDepth=6, featureSubsetStrategy="0.5", featuresCol="x", labelCol="label", predictionCol="p", seed=seed, subsamplingRate=0.8
    )


def fit(train: DataFrame, kind: str, rounds: int = 300):
    """Fit on rows of the feature matrix with a target."""
    stages = [
        StringIndexer(inputCol=KEY, outputCol="_k", handleInvalid="keep"),
        VectorAssembler(inputCols=[*FEATURES, "_k"], outputCol="x", handleInvalid="keep"),
        learner(kind, rounds),
    ]
    rows = relative(train).where("label is not null").select(KEY, "ds", *FEATURES, "label")
    return Pipeline(stages=stages).fit(rows)


def predict(model, rows: DataFrame, into: str) -> DataFrame:
    """The predicted next close of each row."""
    names = rows.columns
    plain = rows.withColumn("_close", F.col("close"))
    out = model.transform(relative(plain))
    keys = out.select(KEY, "ds", (F.col("_close") * (1 + F.col("p"))).alias(into))
    return rows.join(keys, [KEY, "ds"]).select(*names, into)


def holdout(matrix: DataFrame, kind: str, into: str, n: int = 30, rounds: int = 300) -> DataFrame:
    """One-step predictions for the last n rows of each series by a model that has not seen them: ``ticker, ds, previous, actual, into``.

    ``ds`` is the day that is predicted, ``previous`` the close before it.
    """
    marked = from_end(matrix, n, time="ds")
    model = fit(marked.where("_back is null"), kind, rounds)
    out = predict(model, marked.where("_back is not null"), into)
    return out.select(KEY, F.col("target_day").alias("ds"), F.col("close").alias("previous"), F.col("target_next_close").alias("actual"), into)
