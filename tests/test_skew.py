"""Keys that hold a large share of the rows: same results, spread work."""

import pytest
from pyspark.sql import functions as F

from tests.helpers import rows_of
from trolley.functions.joins import hot_keys, hot_share, lookup_join, per_key
from trolley.operators import pair
from trolley.sources import star


def fact_rows(spark):
    """Key 1 holds 4,000 of 6,000 rows, key null 10; others a few each."""
    keys = F.when(F.col("id") < 4000, 1).when(F.col("id") < 4010, None).otherwise(F.col("id") % 997 + 2)
    return spark.range(6000).select(keys.cast("long").alias("k"), F.col("id").alias("v"))


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("share", [1 / 1000, 0.5, 1.0])
def test_lookup_join_equals_plain_join(spark, settings, how, share):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    fact = fact_rows(spark)
    # Odd keys only, so that some fact rows find nothing.
    table = spark.range(0, 1000).filter("id % 2 = 1").select(
        F.col("id").alias("k"), (F.col("id") * 10).alias("x"), F.lit(None).cast("string").alias("y")
    )
    got = lookup_join(fact, table, ["k"], ["v"], per_key(fact, "k"), "n", how, share)
    assert rows_of(got) == rows_of(fact.join(table, "k", how).select("k", "v", "x", "y"))


def test_frequent_keys_are_few(spark):
    counts = per_key(fact_rows(spark).filter("k IS NOT NULL"), "k")
    assert rows_of(hot_keys(counts, ["k"], "n", 0.1)) == [(1,)]
    assert hot_keys(counts, ["k"], "n").count() < 1000


def test_frequent_rows_are_spread_over_the_partitions(spark, settings):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )
    fact = fact_rows(spark).filter("k IS NOT NULL")
    table = spark.range(1, 1000).select(F.col("id").alias("k"), F.col("id").alias("x"))
    joined = lookup_join(fact, table, ["k"], ["v"], per_key(fact, "k"), "n")
    sizes = joined.filter("k = 1").groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 4 and max(r["count"] for r in sizes) < 4000 / 2


def test_rows_without_a_key_are_spread_too(spark, settings):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )
    fact = fact_rows(spark).withColumn("k", F.when(F.col("k") > 1, F.col("k")))
    table = spark.range(2, 1000).select(F.col("id").alias("k"), F.col("id").alias("x"))
    joined = lookup_join(fact, table, ["k"], ["v"], per_key(fact, "k"), "n")
    sizes = joined.filter("k IS NULL").groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in sizes) == fact.filter("k IS NULL").count() > 4000
    assert len(sizes) == 4 and max(r["count"] for r in sizes) < 4000 / 2


def skewed_orders(spark):
    """Customer 1 places a third of all orders, many of them on one day."""
    key = F.col("id")
    customer = F.when(key % 3 == 0, 1).otherwise(key % 50 + 2)
    day = F.when(key % 6 == 0, 0).otherwise(key * 7 % 400)
    return spark.range(3000).select(
        key.alias("o_orderkey"), customer.alias("o_custkey"),
        F.date_add(F.lit("1998-01-01").cast("date"), day.cast("int")).cast("timestamp").alias("o_orderdate"),
    )


def test_orders_of_a_frequent_customer_are_numbered_right(spark):
    orders = skewed_orders(spark)
    got = {r["order_id"]: r for r in star.numbered_orders(orders).collect()}
    raw = sorted((r["o_custkey"], r["o_orderdate"], r["o_orderkey"]) for r in orders.collect())
    number, previous = 0, None
    last = {customer: key for customer, _, key in raw}
    for customer, day, key in raw:
        same = previous is not None and previous[0] == customer
        number = number + 1 if same else 1
        row = got[key]
        assert row["order_number"] == number
        assert row["days_since_prior_order"] == (float((day - previous[1]).days % 31) if same else None)
        assert row["eval_set"] == ("train" if last[customer] == key and number > 1 else "prior")
        previous = (customer, day)


def skewed_lines(spark):
    """One pair holds a third of all prior lines, one user half."""
    key = F.col("id")
    return spark.range(1200).select(
        key.alias("order_id"),
        F.when(key % 2 == 0, 1).otherwise(key % 40 + 2).alias("user_id"),
        F.when(key % 3 == 0, 7).otherwise(key % 11 + 100).alias("product_id"),
        (key % 5 + 1).cast("int").alias("add_to_cart_order"),
        (F.pmod(F.xxhash64(key), F.lit(4)) > 0).cast("int").alias("reordered"),
        (key + 1).cast("int").alias("order_number"),
    )


@pytest.mark.parametrize("per_piece", [16, 1 << 16])
def test_pair_features_of_a_frequent_pair(spark, settings, per_piece):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    lines = skewed_lines(spark)
    got = {(r["user_id"], r["product_id"]): r for r in pair.user_product_features(lines, per_piece).collect()}
    history, last = {}, {}
    for r in sorted(lines.collect(), key=lambda r: r["order_number"]):
        history.setdefault((r["user_id"], r["product_id"]), []).append(r)
        last[r["user_id"]] = r["order_number"]
    assert set(got) == set(history)
    for key, rows in history.items():
        flags = [r["reordered"] for r in rows]
        runs = "".join(map(str, flags)).split("0")
        assert got[key]["max_streak"] == max(len(run) for run in runs)
        assert got[key]["u_p_reorder_rate"] == sum(flags) / len(flags)
        assert got[key]["u_p_orders_since_last"] == last[key[0]] - rows[-1]["order_number"]


def test_a_long_history_with_many_lines_per_order(spark):
    """200,000 lines of one pair in 500 orders, each order's lines all alike."""
    key = F.col("id")
    order = F.floor(key / 400).cast("int")
    lines = spark.range(200_000).select(
        order.alias("order_id"), F.lit(1).alias("user_id"), F.lit(7).alias("product_id"),
        F.lit(1).alias("add_to_cart_order"), (order % 50 != 0).cast("int").alias("reordered"),
        order.alias("order_number"),
    )
    for per_piece in (16, 1 << 14):
        assert rows_of(pair.pair_max_streak(lines, per_piece)) == [(1, 7, 49 * 400)]
        row = pair.user_product_features(lines, per_piece).first()
        assert (row["max_streak"], row["u_p_reorder_rate"], row["u_p_orders_since_last"]) == (49 * 400, 0.98, 0)


def test_streaks_start_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("streaks", "")
    pair.user_product_features(skewed_lines(spark))
    pair.pair_max_streak(skewed_lines(spark))
    assert not tracker.getJobIdsForGroup("streaks")
    spark.sparkContext.setJobGroup("", "")


def test_the_limit_for_frequent_keys_follows_the_tasks(spark, settings):
    weights = per_key(fact_rows(spark).filter("k IS NOT NULL"), "k")
    settings(spark__sql__shuffle__partitions="4")
    assert hot_share(weights) == 1 / 1000
    settings(spark__sql__shuffle__partitions="20000")
    assert hot_share(weights) == 1 / 20000


def test_adaptive_execution_splits_a_skewed_join_of_two_shuffles(spark, settings):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="10KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
    )
    lines = spark.range(40000).repartition(8).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("product_id"), F.col("id").alias("v")
    )
    catalog = spark.range(40000).select(F.col("id").alias("product_id"), F.lit("x").alias("name"))
    joined = lines.join(catalog, "product_id", "left")
    assert len(joined.collect()) == 40000
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
