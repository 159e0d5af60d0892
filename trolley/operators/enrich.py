"""Joins that turn the raw tables into one purchase history.

No join carries a broadcast hint: Spark broadcasts a side when its measured
size is below ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles,
splitting skewed partitions.
"""

from pyspark.sql import functions as F

from trolley.schema import COMBINED_COLUMNS, MISSING_AISLE


def enrich_products(products, aisles, departments):
    """Products with the names of their aisle and department."""
    return products.join(aisles, "aisle_id", "left").join(departments, "department_id", "left").select(
        "product_id", "product_name", "aisle_id", "department_id", "aisle", "department"
    )


def combine(order_products, orders, products_merged):
    """Order lines with their order and product columns."""
    return (
        order_products.join(orders, "order_id", "left")
        .join(products_merged, "product_id", "left")
        .select(*COMBINED_COLUMNS)
    )


def train_products(order_products_train, products_merged):
    """Train lines with product columns only."""
    return order_products_train.join(products_merged, "product_id", "left")


def products_in_aisle(products_merged, aisle=MISSING_AISLE):
    """Products filed under one aisle, by default the one for unknown aisles."""
    return products_merged.filter(F.col("aisle") == aisle)


def impute_first_gap(combined):
    """Zero for the missing day gap of a user's first order."""
    return combined.fillna(0.0, ["days_since_prior_order"])
