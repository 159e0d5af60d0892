"""Exploration and data-quality tables."""

from functools import reduce

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trolley.functions.histogram import histogram

__all__ = [
    "average_basket_size", "basket_sizes", "count_by", "dataset_profile", "distinct_users",
    "first_rows", "histogram", "missing_total", "missing_values", "order_count_range",
    "orders_per_user", "reorder_rate_by_name", "target_distribution", "top_values",
]


def count_by(df, key):
    """Rows per value of a column, most frequent first; null is not a value."""
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), key)
    )


def top_values(df, key, k=10):
    """The ``k`` most frequent values of a column."""
    return count_by(df, key).limit(k)


def orders_per_user(orders):
    """Highest order number per user."""
    return orders.groupBy("user_id").agg(F.max("order_number").alias("n_orders"))


def order_count_range(orders):
    """Fewest and most orders of any user."""
    return orders_per_user(orders).agg(
        F.min("n_orders").alias("min_orders"), F.max("n_orders").alias("max_orders")
    )


def reorder_rate_by_name(lines, k=None):
    """Mean ``reordered`` per product name, highest first."""
    rates = (
        lines.filter(F.col("product_name").isNotNull())
        .groupBy("product_name")
        .agg(F.avg("reordered").alias("reorder_rate"))
        .orderBy(F.desc("reorder_rate"), "product_name")
    )
    return rates.limit(k) if k else rates


def basket_sizes(lines):
    """Products per order."""
    return lines.dropna(subset=["order_id"]).groupBy("order_id").agg(F.count("product_id").alias("basket_size"))


def average_basket_size(lines):
    """Mean lines per order."""
    per_order = lines.dropna(subset=["order_id"]).groupBy("order_id").agg(F.count("*").alias("n"))
    return per_order.agg(F.avg("n").alias("avg_cart_size"))


def _null_counts(df, columns):
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def missing_values(df, columns=None):
    """Columns with nulls and how many, worst first; one pass over the data."""
    columns = columns or df.columns
    counts = _null_counts(df, columns).unpivot([], columns, "column_name", "n_missing")
    return counts.filter(F.col("n_missing") > 0).orderBy(F.desc("n_missing"), "column_name")


def missing_total(df):
    """Nulls over all columns."""
    counts = _null_counts(df, df.columns)
    return counts.select(reduce(lambda a, b: a + b, [F.col(c) for c in df.columns]).alias("n_missing"))


def target_distribution(**datasets):
    """Share of each ``reordered`` value per named data set."""
    counts = reduce(
        lambda a, b: a.unionByName(b),
        [
            df.filter(F.col("reordered").isNotNull())
            .groupBy("reordered")
            .agg(F.count("*").alias("n"))
            .select(F.lit(name).alias("dataset"), "reordered", "n")
            for name, df in datasets.items()
        ],
    )
    total = F.sum("n").over(W.partitionBy("dataset"))  # over one row per label value
    return counts.select(
        "dataset", "reordered", (F.col("n").cast("double") / total).alias("percentage")
    )


def distinct_users(orders):
    """How many users placed an order."""
    return orders.agg(F.countDistinct("user_id").alias("total_users"))


def dataset_profile(datasets):
    """Per table: rows, columns, column names, nulls; one pass each."""
    def profile(name, df):
        nulls = reduce(
            lambda a, b: a + b, [F.count_if(F.col(c).isNull()) for c in df.columns]
        )
        return df.agg(F.count("*").alias("n_rows"), nulls.alias("n_missing")).select(
            F.lit(name).alias("table_name"),
            "n_rows",
            F.lit(len(df.columns)).alias("n_columns"),
            F.lit(",".join(df.columns)).alias("column_names"),
            "n_missing",
        )

    return reduce(
        lambda a, b: a.unionByName(b), [profile(name, df) for name, df in datasets.items()]
    )


def first_rows(df, keys, n=3):
    """The first rows in key order."""
    return df.orderBy(*keys).limit(n)
