"""Small frames with answers worked out by hand."""

import random

import pytest
from pyspark.sql import functions as F

from tests.helpers import combined, longest_run, rows_of
from trolley.functions import columns
from trolley.functions.histogram import histogram
from trolley.functions.runs import longest_run as run_column
from trolley.operators import (
    enrich, explore, pair, product, rates, recommend, reports, training, user,
)


def test_title_case_capitalises_every_letter_run(spark):
    df = spark.createDataFrame([("it's co-op MILK",), (None,)], "s string")
    assert rows_of(df.select(columns.title_case("s").alias("t"))) == [(None,), ("It'S Co-Op Milk",)]


def test_round_even_at_exact_halves(spark):
    df = spark.createDataFrame([(0.0625,), (0.1875,), (2.5,)], "x double")
    assert [r[0] for r in df.select(columns.round_even("x", 3)).collect()] == [0.062, 0.188, 2.5]


def test_ratio_of_zero_denominator_is_null(spark):
    df = spark.createDataFrame([(1, 0), (1, 2)], "a int, b int")
    assert [r[0] for r in df.select(columns.ratio("a", "b")).collect()] == [None, 0.5]


def test_lookup_default_and_null(spark):
    df = spark.createDataFrame([(1,), (9,), (None,)], "k int")
    names = {1: "one", 2: "two"}
    got = df.select(columns.lookup("k", names).alias("a"), columns.lookup("k", names, "?").alias("b"))
    assert [tuple(r) for r in got.collect()] == [("one", "one"), (None, "?"), (None, "?")]


def test_flags_treat_null_as_absent(spark):
    df = spark.createDataFrame([("ORGANIC milk", 4), (None, None), ("milk", 5)], "name string, d int")
    got = df.select(columns.contains_flag("name", "Organic"), columns.equals_flag("d", 4))
    assert [tuple(r) for r in got.collect()] == [(1, 1), (0, 0), (0, 0)]


def test_week_day_starts_on_sunday(spark):
    df = spark.sql("SELECT DATE '2024-06-02' AS sunday, TIMESTAMP '2024-06-08 23:00:00' AS saturday")
    assert tuple(df.select(columns.week_day("sunday"), columns.week_day("saturday")).first()) == (0, 6)


@pytest.mark.parametrize("per_piece", [1, 2, 3, 100])
@pytest.mark.parametrize(
    "flags", [[0], [1], [0, 1, 1], [1, 1, 0, 1, 1, 1], [1, 0, 1, 0], [1] * 7, [0] * 5, [1, 1, 1, 0, 1, 1]]
)
def test_longest_run_in_pieces(spark, flags, per_piece):
    df = spark.createDataFrame([(1, i, flag) for i, flag in enumerate(flags)][::-1], "k int, i int, f int")
    got = run_column(df, ["k"], ["i"], "f", F.floor(F.col("i") / per_piece))
    assert rows_of(got) == [(1, longest_run(flags))]


def test_longest_run_of_random_histories(spark):
    draw = random.Random(7)
    histories = {
        key: [int(draw.random() < draw.choice([0.2, 0.7, 0.95])) for _ in range(draw.randint(1, 60))]
        for key in range(300)
    }
    rows = [(key, i, flag) for key, flags in histories.items() for i, flag in enumerate(flags)]
    draw.shuffle(rows)
    df = spark.createDataFrame(rows, "k int, i int, f int")
    want = sorted((key, longest_run(flags)) for key, flags in histories.items())
    for piece in (F.lit(0), F.floor(F.col("i") / 7), F.floor(F.col("i") / 20)):
        assert rows_of(run_column(df, ["k"], ["i"], "f", piece)) == want


def history(spark):
    """User 1: five orders with product 10, one with 11; user 2: a single order."""
    flags = [0, 1, 1, 0, 1]
    lines = [
        {"user_id": 1, "order_id": 100 - n, "order_number": n + 1, "product_id": 10, "reordered": flag,
         "add_to_cart_order": n + 1, "days_since_prior_order": None if n == 0 else 7.0}
        for n, flag in enumerate(flags)
    ]
    lines.append({"user_id": 1, "order_id": 99, "order_number": 2, "product_id": 11, "product_name": "product 10",
                  "reordered": 0, "add_to_cart_order": 9, "days_since_prior_order": 7.0})
    lines.append({"user_id": 2, "order_id": 50, "order_number": 1, "product_id": 12})
    return combined(spark, lines)


def test_pair_features_by_hand(spark):
    got = rows_of(pair.user_product_features(history(spark)))
    assert got == [
        (1, 10, 5 / 6, 3 / 5, 3.0, 0, 2),
        (1, 11, 1 / 6, 0.0, 9.0, 3, 0),
        (2, 12, 1.0, 0.0, 1.0, 0, 0),
    ]
    assert rows_of(pair.user_product_features(history(spark), orders_per_piece=2)) == got


def test_streak_follows_order_numbers_not_ids(spark):
    # Order ids run against order numbers in this history.
    assert rows_of(pair.pair_max_streak(history(spark)))[0] == (1, 10, 2)


def test_user_features_by_hand(spark):
    got = {r["user_id"]: r for r in user.user_features(history(spark)).collect()}
    one, two = got[1], got[2]
    assert one["user_reorder_rate"] == 0.5
    assert one["user_unique_products"] == 1  # two ids share a name
    assert one["user_total_products"] == 6
    assert one["user_avg_cart_size"] == 6 / 5
    assert one["user_avg_days_between_orders"] == 7.0  # the first order's gap is skipped
    assert one["user_reordered_products_ratio"] == 1.0
    assert two["user_avg_days_between_orders"] is None  # a single order
    assert two["user_reordered_products_ratio"] == 0.0


def test_null_keys_are_left_out(spark):
    lines = combined(spark, [
        {"user_id": 1, "order_id": 1, "product_id": 1, "reordered": 1},
        {"user_id": None, "order_id": 2, "product_id": 1},
        {"user_id": 1, "order_id": 1, "product_id": None},
    ])
    assert rows_of(pair.interaction_counts(lines)) == [(1, 1, 1)]
    assert rows_of(product.product_reorder_rate(lines)) == [(1, 0.5)]
    assert [r["user_id"] for r in user.user_features(lines).collect()] == [1]
    assert rates.rate_table(lines, "u_days_since_prior_order_reorder_rate").count() == 0


def test_product_never_reordered_has_rate_zero(spark):
    got = {r["product_id"]: r for r in product.product_statistics(
        history(spark), spark.createDataFrame(
            [(10, "a", 1, 1), (11, "b", 1, 1), (12, "c", 1, 1)],
            "product_id long, product_name string, aisle_id int, department_id int")).collect()}
    assert got[11]["product_reorder_rate"] == 0.0
    assert got[10]["aisle_reorder_rate"] == got[12]["aisle_reorder_rate"] == 3 / 7


def test_unknown_aisle_keeps_the_product(spark):
    products = spark.createDataFrame(
        [(1, "a", 1, 1), (2, "b", 99, 1)], "product_id long, product_name string, aisle_id int, department_id int"
    )
    aisles = spark.createDataFrame([(1, "missing")], "aisle_id int, aisle string")
    departments = spark.createDataFrame([(1, "d")], "department_id int, department string")
    merged = enrich.enrich_products(products, aisles, departments)
    assert rows_of(merged, "product_id", "aisle") == [(1, "missing"), (2, None)]
    assert rows_of(enrich.products_in_aisle(merged), "product_id") == [(1,)]


def training_tables(spark):
    prior = combined(spark, [
        {"user_id": 1, "order_id": 1, "product_id": 10, "order_number": 1},
        {"user_id": 1, "order_id": 2, "product_id": 10, "order_number": 2, "reordered": 1, "order_dow": 3,
         "order_hour_of_day": 8, "days_since_prior_order": 5.0},
        {"user_id": 1, "order_id": 2, "product_id": 11, "order_number": 2, "order_dow": 3,
         "order_hour_of_day": 8, "days_since_prior_order": 5.0},
        {"user_id": 2, "order_id": 3, "product_id": 10, "order_number": 1},
    ])
    train = combined(spark, [
        {"user_id": 1, "order_id": 9, "product_id": 10, "order_number": 3, "reordered": 1, "order_dow": 3,
         "order_hour_of_day": 8, "days_since_prior_order": 5.0},
        {"user_id": 1, "order_id": 9, "product_id": 77, "order_number": 3, "order_dow": 3,
         "order_hour_of_day": 8, "days_since_prior_order": 5.0},
    ], "train")
    return prior, train


def test_training_set_by_hand(spark):
    prior, train = training_tables(spark)
    got = training.training_set(pair.user_product_features(prior), train, rates.rate_tables(prior))
    rows = {r["product_id"]: r.asDict() for r in got.collect()}
    # Product 77 is new in train; user 2 has no train order.
    assert set(rows) == {10, 11} and {r["user_id"] for r in rows.values()} == {1}
    assert rows[10]["reordered"] == 1.0 and rows[11]["reordered"] == 0.0
    assert rows[10]["hour_reorder_rate"] == 1.0 and rows[11]["hour_reorder_rate"] == 0.0
    assert rows[10]["u_days_since_prior_order_reorder_rate"] == 0.5
    assert rows[10]["days_since_prior_reorder_rate"] == 1.0
    assert rows[10]["order_id"] == 9 and rows[10]["days_since_prior_order"] == 5.0


def test_rates_default_to_zero_for_first_orders(spark):
    prior, _ = training_tables(spark)
    train = combined(spark, [
        {"user_id": 2, "order_id": 8, "product_id": 10, "order_number": 2, "order_dow": 6,
         "order_hour_of_day": 23, "days_since_prior_order": None},
    ], "train")
    row = training.training_set(pair.user_product_features(prior), train, rates.rate_tables(prior)).first()
    assert [row[name] for name in rates.RATE_KEYS] == [0.0] * 5


def test_candidates_survive_a_day_gap_without_rates(spark):
    prior, train = training_tables(spark)
    last = recommend.user_last_purchase(train, "2024-06-01")
    got = recommend.context_features(
        recommend.user_product_snapshot(pair.user_product_features(prior)),
        rates.rate_tables(prior), last, "2024-06-29 08:00:00",
    )
    rows = {r["product_id"]: r for r in got.collect()}
    assert set(rows) == {10, 11}  # both kept although the gap of 28 was never seen
    assert rows[10]["days_since_prior_order"] == 28.0 and rows[10]["order_dow"] == 6
    assert rows[10]["hour_reorder_rate"] == 1.0 and rows[10]["days_since_prior_reorder_rate"] == 0.0


def test_slot_ties_go_by_name(spark):
    lines = combined(spark, [
        {"user_id": 1, "order_id": i, "product_id": i, "product_name": name}
        for i, name in enumerate(["b", "a", "c", "c"])
    ])
    assert rows_of(recommend.top_products_by_slot(lines, 2), "rank", "product_name") == [(1, "c"), (2, "a")]


def test_routing(spark):
    users = spark.createDataFrame([(1,), (2,), (2,)], "user_id long")
    last = spark.createDataFrame([(1, 9)], "user_id long, order_id long")
    personal = spark.createDataFrame([(1, 1, "mine")], "user_id long, rank int, product_name string")
    slots = spark.createDataFrame(
        [(0, 8, "x", 5, 1), (0, 8, "y", 4, 2), (1, 8, "z", 9, 1)],
        "order_dow int, order_hour_of_day int, product_name string, count long, rank int",
    )
    now = "2024-06-02 08:30:00"
    got = rows_of(recommend.route(users, last, personal, slots, now))
    assert got == [(1, False, 1, "mine"), (2, True, 1, "x"), (2, True, 2, "y")]
    assert rows_of(recommend.recommend_new(slots, now)) == [(0, "x"), (1, "y")]
    # A slot without sales has nothing to offer, and no one gets rows for it.
    empty = rows_of(recommend.route(users, last, personal, slots, "2024-06-04 03:00:00"))
    assert empty == [(1, False, 1, "mine")]


def test_histogram_edges(spark):
    def bins(values, n):
        df = spark.createDataFrame([(v,) for v in values], "x double")
        return rows_of(histogram(df, "x", n))

    assert bins([0.0, 1.0, 2.0, 4.0, None], 4) == [(0, 0.5, 1), (1, 1.5, 1), (2, 2.5, 1), (3, 3.5, 1)]
    assert [row[2] for row in bins([3.0, 3.0], 2)] == [0, 2]  # equal bounds widen to [2.5, 3.5]
    assert [row[2] for row in bins([0.0, 10.0], 5)] == [1, 0, 0, 0, 1]
    assert bins([None], 2) == [(0, None, 0), (1, None, 0)]


@pytest.mark.parametrize("orders, basket, rate, segment", [
    (15, 12.0, 0.0, "VIP Customers"),
    (15, 11.9, 0.6, "Loyal Customers"),
    (15, 11.9, 0.599, "Regular Customers"),
    (8, 1.0, 0.6, "Loyal Customers"),
    (7, 20.0, 1.0, "Regular Customers"),
    (5, 1.0, 0.0, "Regular Customers"),
    (4, 20.0, 1.0, "New Customers"),
])
def test_segment_boundaries(spark, orders, basket, rate, segment):
    stats = spark.createDataFrame(
        [(1, orders, rate, basket)],
        "user_id long, total_orders long, avg_reorder_rate double, avg_basket_size double",
    )
    assert reports.customer_segments(stats).first()["segment"] == segment


def test_department_pairs_count_orders_once(spark):
    lines = combined(spark, [
        {"user_id": 1, "order_id": order, "product_id": i, "department": department}
        for order, departments in {1: "abb", 2: "ab", 3: "abc", 4: "a"}.items()
        for i, department in enumerate(departments)
    ])
    assert rows_of(reports.department_pair_counts(lines)) == [("a", "b", 3), ("a", "c", 1), ("b", "c", 1)]
    assert rows_of(reports.department_pairs(lines, 2)) == [("a", "b", 3), ("a", "c", 1)]
    assert tuple(reports.cross_category_orders(lines).first()) == (3, 4, 75.0)


def test_ties_take_the_smallest_key(spark):
    lines = combined(spark, [
        {"user_id": 1, "order_id": i, "product_id": i, "department": d, "order_hour_of_day": h, "order_dow": h}
        for i, (d, h) in enumerate([("z", 5), ("a", 5), ("z", 2), ("a", 2)])
    ])
    assert tuple(reports.peak_hour(lines).first()) == (2, 2)
    assert tuple(reports.busiest_day(lines).first()) == (2, 2, "Tuesday")
    assert reports.user_profile(lines).first()["favourite_department"] == "a"


def test_product_rank_rounds_before_sorting(spark):
    lines = combined(spark, [
        {"user_id": 1, "order_id": i, "product_id": p, "product_name": name, "reordered": int(i < hits)}
        for p, (name, total, hits) in enumerate([("many", 2001, 1001), ("few", 2, 1), ("rare", 1, 1)])
        for i in range(total)
    ])
    got = reports.product_reorder_rank(lines, min_count=2).collect()
    assert [(r["product_name"], r["reorder_rate"]) for r in got] == [("many", 0.5), ("few", 0.5)]


def test_missing_values_lists_only_columns_with_nulls(spark):
    df = spark.createDataFrame([(1, None, None), (2, None, "x")], "a int, b int, c string")
    assert rows_of(explore.missing_values(df)) == [("b", 2), ("c", 1)]
    assert explore.missing_total(df).first()[0] == 3


def test_scaling_uses_population_deviation_and_keeps_constants_zero(spark):
    train = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    held_out = spark.createDataFrame([(4.0, 6.0)], "a double, b double")
    scaled, other = training.scale(train, held_out, ["a", "b"])
    assert rows_of(scaled) == [(-1.0, 0.0), (1.0, 0.0)]
    assert rows_of(other) == [(2.0, 1.0)]


def test_last_train_order_context_with_several_orders(spark):
    train = combined(spark, [
        {"user_id": 1, "order_id": 5, "product_id": 1, "order_dow": 1},
        {"user_id": 1, "order_id": 7, "product_id": 2, "order_dow": 4},
    ], "train")
    assert rows_of(training.train_contexts(train), "user_id", "order_id", "order_dow") == [(1, 7, 4)]


def test_lines_without_an_order_or_user_make_no_group(spark):
    lines = combined(spark, [
        {"order_id": 1, "user_id": 1, "product_id": 1, "reordered": 1},
        {"order_id": 2, "user_id": None, "product_id": 1, "reordered": 1, "order_dow": None, "order_hour_of_day": None},
        {"order_id": None, "user_id": 1, "product_id": 2},
    ])
    assert rows_of(recommend.top_products_by_slot(lines), "order_dow", "order_hour_of_day", "count") == [(0, 0, 1), (0, 0, 1)]
    assert {r["user_id"] for r in recommend.user_most_reordered(lines).collect()} == {1}
    assert {r["user_id"] for r in training.last_train_orders(lines).collect()} == {1}
    assert rows_of(explore.basket_sizes(lines)) == [(1, 1), (2, 1)]
    assert explore.average_basket_size(lines).first()[0] == 1.0
    assert reports.most_common_basket_size(lines).first()["n_orders"] == 2
    assert reports.cross_category_orders(lines).first()["orders"] == 2


def test_gaps_stop_at_the_highest_and_later_purchases_are_left_out(spark):
    purchases = spark.sql(
        "SELECT * FROM VALUES (1, DATE '2024-05-30'), (2, DATE '2023-01-01'), (3, DATE '2024-06-09'), "
        "(4, DATE '2024-06-01'), (4, DATE '2024-07-01'), (null, DATE '2024-06-01') AS t(user_id, date)"
    )
    got = recommend.scoring_contexts(purchases, "2024-06-08 09:00:00")
    assert rows_of(got, "user_id", "days_since_prior_order") == [(1, 9.0), (2, 30.0), (4, 7.0)]
