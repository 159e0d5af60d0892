"""Every query with a SQL twin equals it; the others return rows."""

import pytest

from checks.compare import connect, difference
from checks.oracle import ORACLES
from checks.queries import QUERIES
from tests.conftest import SMALL

MODEL_QUERIES = {
    "logistic_regression", "decision_tree_search", "calibrated_forest", "perceptron",
    "boosted_trees_early_stop", "boosted_trees", "free_trees", "oblivious_trees", "minibatch_network", "model_families",
    "permutation_importance", "feature_importance", "model_comparison",
    "saved_model_scores", "recommendations",
}
FACTOR_QUERIES = {"reduced_features", "product_features", "final_features_with_factors"}


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, duck, name):
    assert difference(QUERIES[name](spark, SMALL), duck, ORACLES[name]) is None


def test_only_models_and_factors_lack_sql():
    assert set(QUERIES) - set(ORACLES) == MODEL_QUERIES | FACTOR_QUERIES
    assert set(ORACLES) <= set(QUERIES)


def test_entry_point(spark):
    import __spark_entry__ as entry

    result = entry.entry(spark)
    assert len(result.columns) == 17 and result.count() > 0
    assert set(entry.queries()) >= set(QUERIES) and set(entry.oracle_sql()) >= set(ORACLES)
    assert set(entry.oracle_sql()) <= set(entry.queries())
