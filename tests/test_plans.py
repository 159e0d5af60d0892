"""Whole jobs, and the shape of the physical plans."""

import re

import pytest
from pyspark.sql import functions as F

from checks.queries import BASKET_QUERIES, FLAGS
from tests.helpers import rows_of
from trolley.operators import recommend
from trolley.operators.rates import RATE_KEYS
from trolley.plans import features, report, serve, train
from trolley.schema import PAIR_FEATURES, PRODUCT_FEATURES, USER_FEATURES
from trolley.sources import tables
from trolley.sources.releases import Release

LAZY = sorted(set(BASKET_QUERIES) - {
    "logistic_regression", "decision_tree_search", "calibrated_forest", "perceptron",
    "boosted_trees_early_stop", "boosted_trees", "feature_importance", "model_comparison",
    "saved_model_scores", "saved_model_agreement", "recommendations", "recommendation_counts", "load_tables", "processed_table", "read_prefix",
    "publish_serving_tables", "boosted_trees_rounds", "free_trees", "oblivious_trees", "minibatch_network",
    "model_families", "permutation_importance", "checked_tables", "released_table_rows",
})


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_jobs_from_raw_files_to_recommendations(spark, baskets, tmp_path):
    raw, processed, trained = (str(tmp_path / n) for n in ("raw", "processed", "trained"))
    for name, (stem, _) in tables.RAW_TABLES.items():
        tables.write_table(baskets.raw_tables[name], f"{raw}/{stem}.csv", "csv")

    summary = features.run(spark, raw, processed, "csv", FLAGS).first()
    assert summary["total_features"] == 18
    assert summary["columns"].split(",")[2:] == PAIR_FEATURES + USER_FEATURES + PRODUCT_FEATURES
    assert summary["total_rows"] == baskets.pairs.count()
    stored = tables.read_table(spark, f"{processed}/user_product_features")
    assert rows_of(stored) == rows_of(baskets.pairs)

    names = report.run(spark, processed, f"{trained}/reports")
    assert len(names) == 32
    got = tables.read_table(spark, f"{trained}/reports/customer_stats")
    assert rows_of(got) == rows_of(BASKET_QUERIES["customer_stats"](baskets))

    scores = train.run(
        spark, processed, trained, rounds=5, max_depth=3, step=0.2, order_dates=baskets.order_dates, n_buckets=4,
        families={"oblivious_trees": {"rounds": 2, "depth": 2, "step": 0.3}},
    ).collect()
    assert {r["model"] for r in scores} == {"boosted_trees", "oblivious_trees"} and all(0 < r["log_loss_val"] < 1 for r in scores)
    assert tables.read_table(spark, f"{trained}/permutation_importance/oblivious_trees").count() == 13
    assert rows_of(tables.read_table(spark, f"{trained}/training_set")) == rows_of(baskets.training_set)

    users = baskets.orders.select("user_id").distinct()
    release = Release(spark, f"{trained}/serving")
    assert release.rows()["user_product_snapshot"] == baskets.pairs.count()
    snapshot = recommend.serving_table(release, "user_product_snapshot")
    rate_tables = {n: recommend.serving_table(release, n) for n in RATE_KEYS}
    purchases = recommend.serving_table(release, "user_last_purchase")
    scored = recommend.context_features(snapshot, rate_tables, purchases, "1998-08-20 14:00:00")
    assert scored.count() and not scored.filter(~F.col("days_since_prior_order").between(0, 30)).count()
    got = serve.run(spark, trained, users, "2001-08-02 14:00:00", k=5)
    rows = got.collect()
    known = baskets.train.select("user_id").distinct().count()
    assert len({r["user_id"] for r in rows if not r["cold_start"]}) == known
    assert {r["user_id"] for r in rows} == {r["user_id"] for r in users.collect()}
    assert max(r["rank"] for r in rows if not r["cold_start"]) <= 5


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_join_in_plans(baskets, name):
    text = plan(BASKET_QUERIES[name](baskets))
    for operator in ("Python", "Pandas", "InArrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in text, operator


def test_scans_read_only_needed_columns(baskets):
    columns = re.search(r"FileScan parquet \[([^\]]*)\]", plan(BASKET_QUERIES["hour_reorder_rate"](baskets)))
    assert {c.split("#")[0] for c in columns[1].split(",")} == {"product_id", "reordered", "order_hour_of_day"}


def test_filters_reach_the_scan(baskets):
    assert "PushedFilters: [IsNotNull(days_since_prior_order)" in plan(
        BASKET_QUERIES["mean_reorder_cycle"](baskets)
    )


@pytest.mark.parametrize("name", ["slot_products", "user_most_reordered", "best_by_order_rate"])
def test_best_per_group_is_trimmed_before_the_shuffle(baskets, name):
    assert "WindowGroupLimit" in plan(BASKET_QUERIES[name](baskets))


@pytest.mark.parametrize("name", ["popular_products", "department_pairs", "product_reorder_rank", "first_rows"])
def test_overall_best_needs_no_full_sort(baskets, name):
    assert "TakeOrderedAndProject" in plan(BASKET_QUERIES[name](baskets))
