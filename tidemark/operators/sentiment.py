"""Headline sentiment: scoring once per distinct headline, daily and weekly aggregates."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.keyed import new_rows

# The lexicon of the registered queries, tokens of the invented prose with their signs.
POSITIVE = ["the", "for", "was", "sur", "des", "und", "los"]
NEGATIVE = ["that", "with", "from", "les", "par", "von", "del"]
# Scores of a headline that cannot be scored.
FALLBACK = {"score_pos": 0.33, "score_neg": 0.33, "score_neu": 0.34}
SCORES = ["score_pos", "score_neg", "score_neu"]


def lexicon_scores(rows: DataFrame, positive: list[str] = POSITIVE, negative: list[str] = NEGATIVE) -> DataFrame:
    """Shares of positive, negative and other words of ``headline``; the fallback for a headline without words.

    The words are a column of their own, so that a text is cut once for all three.
    """
    rows = rows.withColumn("_words", F.array_remove(F.split(F.lower("headline"), "[^a-z]+"), ""))
    hits = lambda names: F.size(F.filter("_words", lambda w: w.isin(names))).cast("double")
    rows = rows.withColumns({"_n": F.size("_words"), "_pos": hits(positive), "_neg": hits(negative)})
    pos, neg = F.try_divide("_pos", "_n"), F.try_divide("_neg", "_n")
    raw = {"score_pos": pos, "score_neg": neg, "score_neu": F.try_divide(F.col("_n") - F.col("_pos") - F.col("_neg"), "_n")}
    return rows.withColumns({c: F.coalesce(v, F.lit(FALLBACK[c])) for c, v in raw.items()}).drop("_words", "_n", "_pos", "_neg")


def labelled(scored: DataFrame) -> DataFrame:
    """Four digits, ``compound`` = positive - negative, and the label of the largest score (first of positive, negative, neutral)."""
    rows = scored.withColumn("compound", F.round(F.col("score_pos") - F.col("score_neg"), 4))
    top = F.greatest(*SCORES)
    label = F.when(F.col("score_pos") == top, "positive").when(F.col("score_neg") == top, "negative").otherwise("neutral")
    return rows.withColumn("sentiment", label).withColumns({c: F.round(c, 4) for c in SCORES})


def by_lexicon(headlines: DataFrame) -> DataFrame:
    """Scores by the lexicon inside the plan."""
    return labelled(lexicon_scores(headlines))


def score(headlines: DataFrame, scorer: Callable[[list[str]], Iterable[tuple[float, float, float]]], clip: int | None = None) -> DataFrame:
    """Score headlines by a batch function; :mod:`headline_model` scores by a trained one, :func:`by_lexicon` by words.

    The function runs once per distinct headline, on Arrow batches, and its scores
    are joined back by a 64-bit hash beside the text; null scores give the fallback.  ``clip`` is for a model with an input
    limit: it sees that many characters; by default whole texts are scored.
    """

    def run(batches: Iterator) -> Iterator:
        for frame in batches:
            got = list(scorer(frame["_clip"].tolist())) if len(frame) else []
            for k, c in enumerate(SCORES):
                frame[c] = [float("nan") if g is None else float(g[k]) for g in got]
            yield frame

    clipped = headlines.withColumn("_clip", F.left("headline", F.lit(clip)) if clip else F.col("headline")).withColumn("_hash", F.xxhash64("_clip"))
    texts = clipped.select("_hash", "_clip").where("_clip is not null").dropDuplicates(["_hash", "_clip"])
    scores = texts.mapInPandas(run, "_hash long, _clip string, score_pos double, score_neg double, score_neu double")
    joined = clipped.join(scores, ["_hash", "_clip"], "left").drop("_hash", "_clip")
    return labelled(joined.withColumns({c: F.coalesce(F.nanvl(c, F.lit(None)), F.lit(FALLBACK[c])) for c in SCORES}))


def score_new(stored: DataFrame, headlines: DataFrame, how: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Scores, by ``how``, of the headlines that are not stored yet; a headline without a date is known by ticker and text."""
    return how(new_rows(stored, headlines, ["ticker", "headline", "published_at"], ["source"]))


def daily(scored: DataFrame) -> DataFrame:
    """Mean compound, positive, negative and all articles per ticker and day."""
    return scored.groupBy("ticker", F.to_date("published_at").alias("ds")).agg(
        F.avg("compound").alias("sentiment_compound"),
        F.count_if(F.col("sentiment") == "positive").alias("pos_count"),
        F.count_if(F.col("sentiment") == "negative").alias("neg_count"),
        F.count("*").alias("article_count"),
    )


def summary(scored: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """Mean compound, class counts and last time per ticker over the last days."""
    recent = scored.where((F.col("published_at") >= as_of - F.make_dt_interval(F.lit(days))) & (F.col("published_at") <= as_of))
    return recent.groupBy("ticker").agg(
        F.avg("compound").alias("avg_compound"),
        F.count_if(F.col("sentiment") == "positive").alias("positive"),
        F.count_if(F.col("sentiment") == "negative").alias("negative"),
        F.count_if(F.col("sentiment") == "neutral").alias("neutral"),
        F.count("*").alias("total"),
        F.max("published_at").alias("latest"),
    )


def zone(value: Column, edge: float = 0.1) -> Column:
    return F.when(value > edge, "POSITIVE").when(value < -edge, "NEGATIVE").otherwise("NEUTRAL")


def roll_forward(daily_rows: DataFrame, bar_days: DataFrame, time: str = "ds") -> DataFrame:
    """Daily sentiment moved to the ticker's next day with a bar, so that news of closed days counts on the next one.

    ``bar_days``: ticker and day of every bar.  Means are weighted by articles;
    news after the last bar has no day yet and is left out.
    """
    from pyspark.sql import Window

    marks = bar_days.select("ticker", time, F.col(time).alias("_bar")).distinct()
    both = daily_rows.withColumn("_bar", F.lit(None).cast(bar_days.schema[time].dataType)).unionByName(marks, allowMissingColumns=True)
    ahead = Window.partitionBy("ticker").orderBy(F.col(time).desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    moved = both.withColumn("_to", F.min("_bar").over(ahead)).where("article_count is not null and _to is not null")
    return moved.groupBy("ticker", F.col("_to").alias(time)).agg(
        F.try_divide(F.sum(F.col("sentiment_compound") * F.col("article_count")), F.sum("article_count")).alias("sentiment_compound"),
        F.sum("pos_count").alias("pos_count"),
        F.sum("neg_count").alias("neg_count"),
        F.sum("article_count").alias("article_count"),
    )
