"""Every query with SQL gives the rows DuckDB gives; the others give rows."""

from __future__ import annotations

import pytest

from catalog import ORACLES, QUERIES
from tests.oracle import check_all

# Searches and fits of several models: covered by test_models and by `python -m tests.oracle`.
SLOW = {
    "training_report_with_failure",
    "evaluate_models", "grid_search", "random_search", "learning_curve", "search_with_resampling", "permutation_importance_of_model",
    "train_regression_candidates", "write_importances", "random_forest_classifier",
}


@pytest.fixture(scope="module")
def differences(spark, sf_dir):
    """All queries once, several at a time."""
    return check_all(spark, sf_dir, {n: f for n, f in QUERIES.items() if n not in SLOW}, ORACLES, threads=6)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW))
def test_query(differences, name):
    assert differences[name] is None, differences[name]


def test_every_oracle_has_its_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    from __spark_entry__ import entry, oracle_sql, queries

    assert entry(spark).count() > 0
    assert set(oracle_sql()) <= set(queries())
