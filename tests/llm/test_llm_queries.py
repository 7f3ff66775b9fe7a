"""The registered queries against their SQL, and the pipeline."""

import hashlib

import duckdb
import pytest

import __spark_entry__ as entry
from tidemark.llm.entries import ORACLE_SQL, QUERIES

TABLES = ["documents", "benchmark", "conversations", "labels", "pages"]


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_against_sql(spark, sf_dir, name):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    want = db.execute(ORACLE_SQL[name]).fetchdf()
    got = QUERIES[name](spark, sf_dir).toPandas()
    columns, key = sorted(want.columns), list(want.columns)[0]
    assert sorted(got.columns) == columns
    a, b = (x[columns].sort_values(key).reset_index(drop=True) for x in (got, want))
    assert a.astype(str).equals(b.astype(str))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() >= spark.read.parquet(f"{sf_dir}/pages.parquet").count()


def test_pipeline_stages(spark, sf_dir, tmp_path):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, seen = docs.columns, [docs.count()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        if k < 4:
            assert docs.columns == columns
            seen.append(docs.count())
    assert seen == sorted(seen, reverse=True) and seen[-1] > 0.5 * seen[0]
    last = spark.read.parquet(f"{tmp_path}/3").toPandas()
    assert set(last.doc_id) == {r.doc_id for r in docs.select("doc_id").distinct().collect()}
    assert "pipeline" in entry.queries()
    assert last.text.map(lambda t: hashlib.md5(t.encode()).hexdigest()).is_unique
