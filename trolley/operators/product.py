"""Product features."""

from pyspark.sql import functions as F

from trolley.functions.columns import contains_flag, equals_flag, ratio
from trolley.operators.factors import pattern_factors
from trolley.schema import CATEGORY_FLAGS


def _keyed(prior, key):
    return prior.filter(F.col(key).isNotNull())


def product_reorder_rate(prior):
    """Share of a product's lines that were reorders."""
    return (
        _keyed(prior, "product_id")
        .groupBy("product_id")
        .agg(F.coalesce(F.avg("reordered"), F.lit(0.0)).alias("product_reorder_rate"))
    )


def average_cart_position(prior):
    """Mean cart position per product."""
    return (
        _keyed(prior, "product_id")
        .groupBy("product_id")
        .agg(F.avg("add_to_cart_order").alias("avg_pos_incart"))
    )


def category_flags(products_merged, flags=None):
    """0/1 columns per product: name contains a text, or an id equals a value."""
    flags = CATEGORY_FLAGS if flags is None else flags
    columns = [
        contains_flag("product_name", value).alias(name)
        if kind == "name_contains"
        else equals_flag(kind, value).alias(name)
        for name, (kind, value) in flags.items()
    ]
    return products_merged.select("product_id", *columns)


def _group_rate(prior, key, name):
    totals = _keyed(prior, key).groupBy(key).agg(
        F.count("reordered").alias("total_orders"), F.sum("reordered").alias("reorders")
    )
    return totals.withColumn(name, ratio("reorders", "total_orders"))


def aisle_reorder_rate(prior):
    """Lines, reorders and their ratio per aisle."""
    return _group_rate(prior, "aisle_id", "aisle_reorder_rate")


def department_reorder_rate(prior):
    """Lines, reorders and their ratio per department."""
    return _group_rate(prior, "department_id", "department_reorder_rate")


def product_statistics(prior, products_merged):
    """The features without the reduced ones, for products seen in ``prior``.

    The purchase history is aggregated once, to product level; the aisle and
    department rates are rolled up from that table.
    """
    totals = (
        _keyed(prior, "product_id")
        .groupBy("product_id", "aisle_id", "department_id")
        .agg(
            F.count("reordered").alias("n_lines"),
            F.sum("reordered").alias("n_reorders"),
            F.sum("add_to_cart_order").alias("position_sum"),
            F.count("add_to_cart_order").alias("position_n"),
        )
    )

    def rolled_up(key, name):
        return (
            _keyed(totals, key)
            .groupBy(key)
            .agg(ratio(F.sum("n_reorders"), F.sum("n_lines")).alias(name))
        )

    per_product = totals.groupBy("product_id").agg(
        F.coalesce(ratio(F.sum("n_reorders"), F.sum("n_lines")), F.lit(0.0)).alias(
            "product_reorder_rate"
        ),
        ratio(F.sum("position_sum"), F.sum("position_n")).alias("avg_pos_incart"),
    )
    places = products_merged.select("product_id", "aisle_id", "department_id").distinct()
    return (
        per_product.join(places, "product_id", "left")
        .join(rolled_up("aisle_id", "aisle_reorder_rate"), "aisle_id", "left")
        .join(rolled_up("department_id", "department_reorder_rate"), "department_id", "left")
        .select(
            "product_id", "product_reorder_rate", "avg_pos_incart",
            "aisle_reorder_rate", "department_reorder_rate",
        )
    )


def reduced_features(products_merged, flags=None, k=3, seed=42):
    """The category flags of each product reduced to ``k`` non-negative factors."""
    flagged = category_flags(products_merged, flags)
    names = [c for c in flagged.columns if c != "product_id"]
    return pattern_factors(flagged, names, k=k, seed=seed, prefix="p_reduced_feat_")


def product_features(prior, products_merged, flags=None, k=3, seed=42):
    """All product features, one row per product seen in ``prior``."""
    reduced = reduced_features(products_merged, flags, k, seed)
    return (
        product_statistics(prior, products_merged)
        .join(reduced, "product_id", "left")
        .select(
            "product_id", "product_reorder_rate", "avg_pos_incart",
            *[f"p_reduced_feat_{i + 1}" for i in range(k)],
            "aisle_reorder_rate", "department_reorder_rate",
        )
    )
