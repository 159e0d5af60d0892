"""Properties that hold whatever the data."""

from functools import reduce

from pyspark.sql import functions as F

from tests.helpers import rows_of
from trolley.operators import explore, pair, product, recommend, reports, training, user
from trolley.schema import MODEL_FEATURES, SPLIT_SHARE


def violations(df, condition):
    return df.filter(~condition | condition.isNull()).count()


def test_pair_features(baskets):
    pairs = baskets.pairs
    assert pairs.count() == pairs.select("user_id", "product_id").distinct().count()
    in_range = F.col("u_p_order_rate").between(0, 1) & F.col("u_p_reorder_rate").between(0, 1)
    assert violations(pairs, in_range & (F.col("u_p_orders_since_last") >= 0)) == 0
    sums = pairs.groupBy("user_id").agg(F.sum("u_p_order_rate").alias("total"))
    assert violations(sums, F.abs(F.col("total") - 1) < 1e-9) == 0


def test_streak_is_bounded_by_reorders(baskets):
    reorders = baskets.prior.groupBy("user_id", "product_id").agg(F.sum("reordered").alias("n"))
    both = pair.pair_max_streak(baskets.prior).join(reorders, ["user_id", "product_id"])
    assert violations(both, F.col("max_streak") <= F.col("n")) == 0
    assert violations(both, (F.col("max_streak") == 0) == (F.col("n") == 0)) == 0


def test_counts_add_up(baskets):
    lines = baskets.prior.count()
    assert pair.interaction_counts(baskets.prior).agg(F.sum("interaction_count")).first()[0] == lines
    assert user.user_features(baskets.prior).agg(F.sum("user_total_products")).first()[0] == lines
    assert reports.hourly_pattern(baskets.prior).agg(F.sum("n")).first()[0] == lines
    assert reports.gap_histogram(baskets.prior).agg(F.sum("n")).first()[0] == lines
    orders = baskets.prior.select("order_id").distinct().count()
    assert reports.basket_histogram(baskets.prior).agg(F.sum("n")).first()[0] == orders


def test_rates_lie_between_zero_and_one(baskets):
    for name, table in baskets.rates.items():
        assert violations(table, F.col(name).between(0, 1)) == 0, name


def test_training_set(baskets):
    rows = baskets.training_set
    assert rows.count() == rows.select("user_id", "product_id").distinct().count()
    assert violations(rows, reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in MODEL_FEATURES])) == 0
    assert len(MODEL_FEATURES) == 13
    labelled = baskets.prior.select("user_id", "product_id").distinct().join(
        baskets.train, ["user_id", "product_id"]
    )
    positives = rows.agg(F.sum("reordered")).first()[0]
    assert positives == labelled.agg(F.sum("reordered")).first()[0]


def test_results_do_not_depend_on_partitioning(baskets):
    shuffled = baskets.prior.repartition(7, "add_to_cart_order")
    for operator in (pair.user_product_features, user.user_features, recommend.top_products_by_slot,
                     reports.department_pair_counts, reports.customer_stats):
        assert rows_of(operator(shuffled)) == rows_of(operator(baskets.prior)), operator.__name__


def test_split_is_disjoint_complete_and_stable(baskets):
    rows = baskets.training_set
    train, held_out = training.split(rows)
    total = rows.count()
    assert train.count() + held_out.count() == total
    assert train.join(held_out, ["user_id", "product_id"], "left_semi").count() == 0
    assert abs(held_out.count() / total - SPLIT_SHARE) < 0.02
    again = training.split(rows.repartition(5))[1]
    assert rows_of(again, "user_id", "product_id") == rows_of(held_out, "user_id", "product_id")
    assert training.split(rows, share=0.0)[1].count() == 0
    assert training.split(rows, share=1.0)[0].count() == 0


def test_recommendations_have_gapless_ranks_and_distinct_products(baskets):
    best = recommend.top_scored(baskets.pairs, baskets.products, 10, "u_p_order_rate")
    per_user = best.groupBy("user_id").agg(
        F.count("*").alias("n"), F.max("rank").alias("top"), F.countDistinct("rank").alias("ranks"),
        F.countDistinct("product_id").alias("products"),
    )
    n = F.col("n")
    assert violations(per_user, (n <= 10) & (n == F.col("top")) & (n == F.col("ranks")) & (n == F.col("products"))) == 0
    assert per_user.count() == baskets.pairs.select("user_id").distinct().count()


def test_final_features_keep_every_pair(baskets):
    final = training.final_features(
        baskets.pairs, user.user_features(baskets.prior),
        product.product_statistics(baskets.prior, baskets.products_merged),
    )
    assert final.count() == baskets.pairs.count()
    assert explore.missing_values(final.drop("user_avg_days_between_orders")).count() == 0
