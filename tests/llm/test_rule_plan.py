"""The rules' weights do not weigh on the plan, of which the driver keeps copies."""

from tidemark.llm import ngram_rules


def test_weights_are_not_in_the_plan(spark):
    docs = spark.createDataFrame([(k, f"some words of text {k} and more") for k in range(40)], "doc_id long, text string")
    judged = ngram_rules.judge(docs, docs.select("doc_id").where("doc_id < 20"), 20, at=0.0)
    plans = judged._jdf.queryExecution()
    assert len(plans.toString()) < 200_000
    # the array is read where it is used; no row carries it
    assert "_weights" not in plans.executedPlan().toString()
    # weights given by value mean the same
    weight = ngram_rules.weights(ngram_rules.bucket_counts(docs, docs.select("doc_id").where("doc_id < 20"), 20))
    words = ngram_rules.with_words(docs)
    plain = words.withColumn("fold", ngram_rules.fold()).select("doc_id", ngram_rules.ratio(weight).alias("ratio"))
    assert sorted(judged.select("doc_id", "ratio").collect()) == sorted(plain.collect())
