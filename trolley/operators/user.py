"""User features."""

from pyspark.sql import functions as F

from trolley.functions.columns import ratio


def _users(prior):
    return prior.filter(F.col("user_id").isNotNull())


def user_reorder_rate(prior):
    """Share of a user's lines that were reorders."""
    return _users(prior).groupBy("user_id").agg(F.avg("reordered").alias("user_reorder_rate"))


def user_unique_products(prior):
    """Distinct product names, not ids, per user."""
    return (
        _users(prior)
        .groupBy("user_id")
        .agg(F.countDistinct("product_name").alias("user_unique_products"))
    )


def user_total_products(prior):
    """Lines per user."""
    return _users(prior).groupBy("user_id").agg(F.count("*").alias("user_total_products"))


def _per_order(prior):
    """One row per order: its size and day gap, averaged per user."""
    by_order = (
        _users(prior)
        .filter(F.col("order_id").isNotNull())
        .groupBy("user_id", "order_id")
        .agg(
            F.count("add_to_cart_order").alias("cart_size"),
            F.max("days_since_prior_order").alias("days_between"),
        )
    )
    return by_order.groupBy("user_id").agg(
        F.avg("cart_size").alias("user_avg_cart_size"),
        F.avg("days_between").alias("user_avg_days_between_orders"),
    )


def _per_name(prior):
    """One row per product name first, so no distinct count meets a whole user."""
    by_name = (
        _users(prior)
        .groupBy("user_id", "product_name")
        .agg(
            F.count("*").alias("n"),
            F.count("reordered").alias("n_known"),
            F.sum("reordered").alias("reorders"),
            F.max("reordered").alias("ever_reordered"),
        )
    )
    again = F.col("product_name").isNotNull() & (F.col("ever_reordered") == 1)
    return by_name.groupBy("user_id").agg(
        ratio(F.sum("reorders"), F.sum("n_known")).alias("user_reorder_rate"),
        F.count("product_name").alias("user_unique_products"),
        F.sum("n").alias("user_total_products"),
        F.count_if(again).alias("reordered_names"),
    )


def user_average_cart_size(prior):
    """Mean lines per order of a user."""
    return _per_order(prior).select("user_id", "user_avg_cart_size")


def user_average_days_between_orders(prior):
    """Mean day gap over a user's orders; the first order has none."""
    return _per_order(prior).select("user_id", "user_avg_days_between_orders")


def user_reordered_products_ratio(prior):
    """Share of a user's distinct product names that were ever reordered."""
    return _per_name(prior).select(
        "user_id",
        ratio("reordered_names", "user_unique_products").alias("user_reordered_products_ratio"),
    )


def user_features(prior):
    """All six features per user: one pass by name, one by order."""
    return (
        _per_name(prior)
        .join(_per_order(prior), "user_id", "left")
        .select(
            "user_id",
            "user_reorder_rate",
            "user_unique_products",
            "user_total_products",
            "user_avg_cart_size",
            "user_avg_days_between_orders",
            ratio("reordered_names", "user_unique_products").alias(
                "user_reordered_products_ratio"
            ),
        )
    )
