"""From raw documents to packed training sequences in five stages.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor
kept, and is written as Parquet and read again before the next.  All but the last
return the columns of ``documents``.

An empty or null text goes through every stage: the quality model decides on it,
and rows that are left are near-duplicates of each other.  Every row is a document
of its own, whatever its ``doc_id``: of repeated rows one stays.  Extra columns are kept by
all but the last stage, which returns one row per packed piece.  An empty table gives no piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import contamination, line_quality, packing, simhash, substrings
from tidemark.llm.common import fresh, shared_path, table
from tidemark.llm.tokens import public_path

#: SQL cannot express the learned model, the fingerprints or the tokenizer.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that the line model scores as good."""
    score = fresh(docs, "_score")
    scored = line_quality.score(docs, line_quality.learn(docs, table(spark, sf_dir, "labels")), score)
    return scored.where(F.col(score) >= 0.5).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each class of near-duplicates, that of the smallest id."""
    return simhash.keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove repeated spans of sentences and repeated passages; documents of which nothing is left go, ``n_chars`` follows the text."""
    removed = fresh(docs, "_removed")
    cut = substrings.dedup_spans(docs, removed=removed, run=substrings.RUN).where((F.col(removed) == 0) | (F.trim("text") != ""))
    if "n_chars" in docs.columns:
        changed = F.when(F.col(removed) > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
        cut = cut.withColumn("n_chars", changed)
    return cut.select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that are contaminated by the benchmark."""
    return contamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokenise and pack into sequences of 4096: one row per piece, with its ids."""
    # workers serve all stages one after another, so the encoder's memo is kept small
    return packing.pack(docs, public_path("word_bpe_49k.json"), "space", 2, memo=300_000)


STAGES = [
    ("quality_classifier", quality),
    ("simhash_near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", decontaminate),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
