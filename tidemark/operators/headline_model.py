"""A trained headline scorer: multinomial logistic regression on hashed words and word pairs.

The gradients of a step are summed over the executors; what comes to the driver has classes x ``SIZE`` numbers.  The
model gives shares of the three classes, which are its scores; nothing is scored in Python.  A null or empty headline has no
words and gets the shares of the intercepts.  Rows without a class are not learned from; an empty table cannot be learned from.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, NGram, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.lineage import stored
from .sentiment import SCORES, labelled

CLASSES = ["positive", "negative", "neutral"]
SIZE, PENALTY, STEPS, ENOUGH = 1 << 15, 1e-3, 60, 100


def words(rows: DataFrame) -> DataFrame:
    """Add ``_words``: runs of letters and digits, lower-cased, of ``headline``."""
    return rows.withColumn("_words", F.array_remove(F.split(F.lower(F.coalesce("headline", F.lit(""))), r"[^\p{L}\p{N}]+"), ""))


def learn(rows: DataFrame, size: int = SIZE, penalty: float = PENALTY, steps: int = STEPS) -> PipelineModel:
    """Fit on ``headline`` and ``class``, one of ``CLASSES``.

    A quarter of the rows, by a hash of the headline, is kept for a second regression, of the class on the first one's three
    values, which sets the shares right; with fewer than ``ENOUGH`` rows in it there is no second one.
    """
    target = F.array_position(F.array(*map(F.lit, CLASSES)), F.col("class")) - 1
    known = words(rows).where(F.col("class").isin(CLASSES))
    kept = F.pmod(F.xxhash64(F.coalesce("headline", F.lit("")), F.lit("shares")), F.lit(4)) == 0
    known = known.select("_words", target.cast("double").alias("_class"), kept.alias("_kept"))
    regression = {"family": "multinomial", "labelCol": "_class", "maxIter": steps, "regParam": penalty, "standardization": False}
    cut = [
        NGram(n=2, inputCol="_words", outputCol="_pairs"),
        HashingTF(numFeatures=size, binary=True, inputCol="_words", outputCol="_one"),
        HashingTF(numFeatures=size, binary=True, inputCol="_pairs", outputCol="_two"),
        VectorAssembler(inputCols=["_one", "_two"], outputCol="_x"),
    ]
    # each regression reads its rows several times: texts are cut once, what follows reads the stored vectors
    known = stored(PipelineModel(stages=cut).transform(known).select("_x", "_class", "_kept"), "headline-vectors")
    enough = known.where("_kept").count() >= ENOUGH
    first = LogisticRegression(featuresCol="_x", probabilityCol="_first" if enough else "_p", rawPredictionCol="_raw", predictionCol="_best", **regression)
    model = first.fit(known.where("not _kept") if enough else known)
    if not enough:
        return PipelineModel(stages=[*cut, model])
    second = LogisticRegression(featuresCol="_raw", probabilityCol="_p", rawPredictionCol="_raw_2", predictionCol="_best_2", **regression)
    shares = second.fit(model.transform(known.where("_kept")).select("_raw", "_class"))
    return PipelineModel(stages=[*cut, model, shares])


def score(model: PipelineModel, headlines: DataFrame) -> DataFrame:
    """``headlines`` with the shares of the classes as scores, ``compound`` and ``sentiment``."""
    rest = [c for c in headlines.columns if c not in SCORES]
    # the columns travel in one of their own, so that none clashes with the model's
    rows = words(headlines.select(F.struct(*rest).alias("_row"), "headline")).select("_row", "_words")
    found = model.transform(rows).select("_row", vector_to_array("_p").alias("_p"))
    # a class that no learned row had has no share
    known = [F.coalesce(F.get("_p", k), F.lit(0.0)).alias(c) for k, c in enumerate(SCORES)]
    return labelled(found.select("_row.*", *known))
