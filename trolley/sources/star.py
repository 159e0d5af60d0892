"""Basket tables derived from a retail star schema (orders, lineitem, part).

A product is what parts of one kind (last word of the name), pack and type have
in common: its id is their smallest part key, its name pack and kind, its aisle
the kind and its department the type. Several products share a name. Orders
have a date only, so the hour comes from the order key; day gaps wrap at 31 to
stay in the range the rate tables use.
"""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trolley.functions.joins import lookup_join
from trolley.schema import AISLES, DEPARTMENTS, ORDER_PRODUCTS, ORDERS, PRODUCTS
from trolley.sources.tables import with_schema

GAP_CYCLE = 31
LARGE_PACK_SIZE = 26
PRODUCT = ["product_name", "aisle", "department"]


def described_parts(part):
    """Parts with the name, aisle and department of their product."""
    kind = F.substring_index("p_name", " ", -1)
    pack = F.when(F.col("p_size") >= LARGE_PACK_SIZE, "large").otherwise("small")
    return part.select(
        "p_partkey",
        F.concat_ws(" ", pack, kind).alias("product_name"),
        kind.alias("aisle"),
        F.col("p_type").alias("department"),
    )


def _smallest_part(parts, keys, name):
    return parts.groupBy(*keys).agg(F.min("p_partkey").alias(name))


def product_of_part(part):
    """One row per part: the product it belongs to."""
    parts = described_parts(part)
    return parts.join(_smallest_part(parts, PRODUCT, "product_id"), PRODUCT).select(
        "p_partkey", "product_id"
    )


def aisles(part):
    return with_schema(_smallest_part(described_parts(part), ["aisle"], "aisle_id"), AISLES)


def departments(part):
    named = _smallest_part(described_parts(part), ["department"], "department_id")
    return with_schema(named, DEPARTMENTS)


def products(part):
    catalog = _smallest_part(described_parts(part), PRODUCT, "product_id")
    return with_schema(
        catalog.join(aisles(part), "aisle").join(departments(part), "department"), PRODUCTS
    )


def numbered_orders(orders):
    """Orders with their number, the day gap and the prior / train split.

    A customer may hold a large share of all orders, so no window spans one
    customer's orders: orders are numbered within (customer, day), and only the
    per-day counts, at most one row per calendar day, are accumulated per
    customer.
    """
    placed = orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.to_date("o_orderdate").alias("order_date"),
    )
    customer = W.partitionBy("user_id")
    in_day_order = customer.orderBy("order_date")
    days = placed.groupBy("user_id", "order_date").agg(F.count("*").alias("n")).select(
        "user_id",
        "order_date",
        F.coalesce(
            F.sum("n").over(in_day_order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
        ).alias("earlier"),
        F.lag("order_date").over(in_day_order).alias("previous_date"),
        F.sum("n").over(customer).alias("total"),
    )
    within_day = W.partitionBy("user_id", "order_date").orderBy("order_id")
    gap = F.when(F.col("nth") > 1, 0).otherwise(F.datediff("order_date", "previous_date"))
    return (
        placed.withColumn("nth", F.row_number().over(within_day))
        .join(days, ["user_id", "order_date"])
        .withColumn("order_number", F.col("earlier") + F.col("nth"))
        .select(
            "order_id",
            "user_id",
            F.when((F.col("total") > 1) & (F.col("order_number") == F.col("total")), "train")
            .otherwise("prior")
            .alias("eval_set"),
            F.col("order_number").cast("int"),
            (F.dayofweek("order_date") - 1).alias("order_dow"),
            F.pmod("order_id", F.lit(24)).cast("int").alias("order_hour_of_day"),
            F.pmod(gap, F.lit(GAP_CYCLE)).cast("double").alias("days_since_prior_order"),
            "order_date",
        )
    )


def placed_lines(lineitem, orders, part):
    """Every distinct (order, product) with its cart position and order columns.

    ``orders`` are numbered orders. After the first aggregate an order has at
    most one line per product, so the window over an order is bounded by the
    catalogue.
    """
    distinct_lines = (
        lineitem.select("l_orderkey", "l_partkey", "l_linenumber")
        .join(product_of_part(part), F.col("l_partkey") == F.col("p_partkey"))
        .groupBy(F.col("l_orderkey").alias("order_id"), "product_id")
        .agg(F.min("l_linenumber").alias("line"))
    )
    position = F.row_number().over(W.partitionBy("order_id").orderBy("line", "product_id"))
    return (
        distinct_lines.withColumn("add_to_cart_order", position)
        .drop("line")
        .join(orders.select("order_id", "user_id", "order_number", "eval_set"), "order_id")
    )


PAIR = ["user_id", "product_id"]


def first_orders(placed):
    """Per pair, the number of the first order with it and its lines."""
    return placed.groupBy(*PAIR).agg(F.min("order_number").alias("first_order"), F.count("*").alias("n"))


def with_reordered(placed, first=None):
    """Placed lines with ``reordered``: 1 if the user bought the product in an earlier order.

    ``placed`` and ``first``, its ``first_orders``, are used several times, so pass
    stored tables.
    """
    first = first_orders(placed) if first is None else first
    with_first = lookup_join(
        placed, first.select(*PAIR, "first_order"), PAIR, ["order_id"], weights=first, weight="n", how="inner"
    )
    return with_first.select(
        "order_id",
        "product_id",
        "add_to_cart_order",
        (F.col("order_number") > F.col("first_order")).cast("int").alias("reordered"),
        "eval_set",
    )


def split_lines(lines, eval_set):
    return with_schema(lines.filter(F.col("eval_set") == eval_set), ORDER_PRODUCTS)


def orders_table(numbered):
    return with_schema(numbered, ORDERS)
