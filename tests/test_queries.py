"""Every registered query with SQL against that SQL; the others run."""

import pytest

import __spark_entry__ as entry  # registers the queries
from compare import assert_same, database
from tidemark.plans.registry import QUERIES, SQL

#: Queries that fit trees; their values are tested in test_trees.py.
TREES = {"tree_forecast_7d", "ensemble_forecast", "ensemble_strategy", "ridge_meta_weights", "feature_importance_top5", "gbt_holdout", "leafwise_holdout", "rf_holdout", "holdout_stack", "model_comparison"}


@pytest.fixture(scope="session")
def db(sf_dir):
    return database(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, sf_dir, db, name):
    got = entry.queries()[name](spark, sf_dir).toPandas()
    want = db.execute(SQL[name]).fetchdf()
    assert_same(got, want)


#: The trained headline scorer; its values are tested in test_headline_model.py.
LEARNED = {"headline_scores_trained", "headline_model_left_out"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL) - TREES - LEARNED))
def test_runs(spark, sf_dir, name):
    """What has no SQL and fits no trees: the two linear forecasts; their values are tested in test_series.py."""
    rows = entry.queries()[name](spark, sf_dir).collect()
    assert len(rows) == 5 * 7 and all(r.lower_bound < r.predicted_close < r.upper_bound and r.forecast_date.weekday() < 5 for r in rows)


def test_entry(spark):
    assert entry.entry(spark).limit(5).count() == 5
