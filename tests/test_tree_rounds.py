"""The registered tree queries ask for the production number of trees, at every call."""

import pytest

import __spark_entry__ as entry
from tidemark.operators import boosting, trees

BOOSTED = ["gbt_holdout", "leafwise_holdout", "feature_importance_top5", "tree_forecast_7d", "holdout_stack", "ridge_meta_weights", "model_comparison", "ensemble_forecast", "ensemble_strategy"]


class Asked(Exception):
    pass


@pytest.mark.parametrize("name", BOOSTED)
def test_boosted_queries_fit_300_trees(spark, sf_dir, monkeypatch, name):
    asked = []

    def fit(blocks, models):
        asked.append({s.rounds for s in models})
        raise Asked

    monkeypatch.setattr(boosting, "fit", fit)
    for _ in range(2):  # a second call fits again
        with pytest.raises(Asked):
            entry.queries()[name](spark, sf_dir)
    assert asked == [{300}, {300}]


def test_the_forest_has_300_trees(spark, sf_dir, monkeypatch):
    asked = []

    def learner(kind, rounds=300, seed=42):
        asked.append(rounds)
        raise Asked

    monkeypatch.setattr(trees, "learner", learner)
    with pytest.raises(Asked):
        entry.queries()["rf_holdout"](spark, sf_dir)
    assert asked == [300]
