"""The trained headline scorer: held-out accuracy, calibration and odd rows."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import headline_model
from tidemark.plans import extra_queries
from tidemark.sources import tables


@pytest.fixture(scope="module")
def rows(spark):
    return extra_queries._classes(spark, "/root/testdata/sf0.1").repartition(4).cache()


def test_accuracy_and_shares_on_rows_left_out(rows):
    found = headline_model.score(headline_model.learn(rows.where("not left_out")), rows.where("left_out")).toPandas()
    right = found["class"] == found.sentiment
    commonest = found["class"].value_counts(normalize=True).iloc[0]
    assert len(found) > 1000 and right.mean() > 0.82 and right.mean() > commonest + 0.05
    shares = found[["score_pos", "score_neg", "score_neu"]]
    assert abs(shares.sum(axis=1) - 1).max() < 2e-4 and (found.compound - (found.score_pos - found.score_neg)).abs().max() < 2e-4
    # calibrated: the mean share of a class is how often it comes
    for name, c in zip(headline_model.CLASSES, shares, strict=True):
        assert abs(found[c].mean() - (found["class"] == name).mean()) < 0.06
    assert abs(shares.max(axis=1).mean() - right.mean()) < 0.12


def test_odd_rows(spark):
    good = [("fine good day", "positive"), ("bad awful day", "negative")] * 20
    model = headline_model.learn(spark.createDataFrame([*good, ("x", None), (None, "positive"), (None, "negative")], "headline string, class string"))
    odd = spark.createDataFrame([("good fine", 1, "a"), ("awful bad", 2, "b"), (None, 3, "c"), ("", 4, "d"), ("Good FINE", 5, "e")], "headline string, id int, _p string")
    got = {r.id: r for r in headline_model.score(model, odd).collect()}
    assert got[1].sentiment == "positive" and got[2].sentiment == "negative" and got[5].score_pos == got[1].score_pos and got[1]._p == "a"
    assert got[3].score_pos == got[4].score_pos and all(r.score_neu == 0 for r in got.values())


def test_texts_are_cut_once_and_dealt_out(spark):
    seen = spark.sparkContext.accumulator(0)

    def look(text):
        seen.add(1)
        return text

    good = [(f"fine good day {k}", "positive") for k in range(300)] + [(f"bad awful day {k}", "negative") for k in range(300)]
    rows = spark.createDataFrame(good, "headline string, class string").select(F.udf(look)("headline").alias("headline"), "class")
    headline_model.learn(rows, size=64, steps=2)
    assert seen.value <= 2 * len(good)  # at most once for the words and once for the draw
    # one file with one row group is read by one task; what follows is not
    parts = tables.headlines(spark, "/root/testdata/sf0.01").select(F.spark_partition_id().alias("p"), "headline").where("length(headline) > 0")
    assert parts.select("p").distinct().count() > 1
