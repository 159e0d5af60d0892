"""Features of a user and a product together."""

from pyspark.sql import functions as F

from trolley.functions.columns import ratio
from trolley.functions.joins import lookup_join
from trolley.functions.runs import ORDERS_PER_PIECE, by_piece, counts, history, longest_run, merge, summarise

PAIR = ["user_id", "product_id"]
HISTORY_ORDER = ["order_number", "order_id"]


def _pairs(prior):
    return prior.filter(F.col("user_id").isNotNull() & F.col("product_id").isNotNull())


def interaction_counts(prior):
    """Lines per (user, product)."""
    return _pairs(prior).groupBy(*PAIR).agg(F.count("*").alias("interaction_count"))


def _user_totals(prior):
    return (
        prior.filter(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(F.count("*").alias("user_lines"), F.max("order_number").alias("user_last_order"))
    )


def _with_user_totals(pairs, prior):
    """Pairs with their user's totals; a user may hold most of the pairs."""
    totals = _user_totals(prior)
    return lookup_join(
        pairs, totals, ["user_id"], ["product_id"], weights=totals, weight="user_lines", how="inner"
    )


def pair_order_rate(prior):
    """A pair's share of the user's lines (lines, not orders)."""
    return _with_user_totals(interaction_counts(prior), prior).select(
        *PAIR, ratio("interaction_count", "user_lines").alias("u_p_order_rate")
    )


def pair_reorder_rate(prior):
    """Share of a pair's lines that were reorders."""
    return _pairs(prior).groupBy(*PAIR).agg(
        ratio(F.count_if(F.col("reordered") == 1), F.count("*")).alias("u_p_reorder_rate")
    )


def pair_average_position(prior):
    """Mean cart position per pair."""
    return _pairs(prior).groupBy(*PAIR).agg(F.avg("add_to_cart_order").alias("u_p_avg_position"))


def pair_orders_since_last(prior):
    """The user's last order number minus the last one with the product."""
    last = _pairs(prior).groupBy(*PAIR).agg(F.max("order_number").alias("last_order"))
    return _with_user_totals(last, prior).select(
        *PAIR, (F.col("user_last_order") - F.col("last_order")).alias("u_p_orders_since_last")
    )


def _piece(orders_per_piece):
    """Number of the piece a line's order falls in."""
    return F.floor(F.coalesce("order_number", F.lit(0)) / F.lit(orders_per_piece))


def pair_max_streak(prior, orders_per_piece=ORDERS_PER_PIECE):
    """Longest run of reorders over a pair's purchases in order."""
    lines = _pairs(prior).select(*PAIR, *HISTORY_ORDER, "reordered")
    runs = longest_run(lines, PAIR, HISTORY_ORDER, "reordered", _piece(orders_per_piece))
    return runs.select(*PAIR, F.col("longest_run").cast("int").alias("max_streak"))


def _pair_totals(prior, orders_per_piece):
    """Per pair: lines, reorders, positions, last order and longest streak.

    Lines are counted per order first, then joined in pieces of bounded length,
    then the pieces are merged: a pair may hold any share of the lines.
    """
    sums = ("n", "reorders", "position_sum", "position_n")
    lines = _pairs(prior).select(*PAIR, *HISTORY_ORDER, "add_to_cart_order", "reordered")
    orders = by_piece(lines, PAIR, _piece(orders_per_piece)).groupBy(*PAIR, "piece", *HISTORY_ORDER).agg(
        F.sum("add_to_cart_order").alias("position_sum"),
        F.count("add_to_cart_order").alias("position_n"),
        *counts("reordered"),
    )
    added = [F.sum(c).alias(c) for c in ("position_sum", "position_n")]
    pieces = orders.groupBy(*PAIR, "piece").agg(
        F.sum(F.col("zeros") + F.col("ones")).alias("n"),
        F.sum("ones").alias("reorders"),
        *added,
        F.max("order_number").alias("last_order"),
        summarise(history(HISTORY_ORDER)).alias("run"),
    )
    return pieces.groupBy(*PAIR).agg(
        *[F.sum(c).alias(c) for c in sums],
        F.max("last_order").alias("last_order"),
        merge(F.collect_list(F.struct("piece", "run")))["best"].alias("streak"),
    )


def user_product_features(prior, orders_per_piece=ORDERS_PER_PIECE):
    """All five features per (user, product).

    The user's totals come from their own two-column pass.
    """
    pairs = _pair_totals(prior, orders_per_piece)
    return _with_user_totals(pairs, prior).select(
        *PAIR,
        ratio("n", "user_lines").alias("u_p_order_rate"),
        ratio("reorders", "n").alias("u_p_reorder_rate"),
        ratio("position_sum", "position_n").alias("u_p_avg_position"),
        (F.col("user_last_order") - F.col("last_order")).alias("u_p_orders_since_last"),
        F.col("streak").cast("int").alias("max_streak"),
    )
