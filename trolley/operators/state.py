"""Feature state that new order lines can be merged into.

Every table holds one row per key with sums, maxima and run summaries, from which
the feature and rate tables follow without the lines. Two states of the same key
merge into the state of both sets of lines. Only a streak needs its lines in
order: a pair's state knows its first and last place in the history, and a pair
whose new lines do not all come after the old ones is ``late`` and has to be made
from its lines again.
"""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import functions as F

from trolley.functions.columns import ratio
from trolley.functions.joins import lookup_join
from trolley.functions.runs import ORDERS_PER_PIECE, SUMMARY_TYPE, by_piece, counts, history, merge, summarise
from trolley.operators.pair import HISTORY_ORDER, PAIR
from trolley.operators.rates import RATE_KEYS

PLACE_TYPE = "struct<order_number:int,order_id:long>"


@dataclass(frozen=True)
class Sums:
    """A state table of sums and maxima per key."""

    keys: tuple
    key_types: tuple
    columns: dict  # name -> ("sum" or "max", SQL expression over lines, type)
    optional: tuple = ()  # keys that may be null

    @property
    def schema(self):
        keys = [f"{k} {t}" for k, t in zip(self.keys, self.key_types)]
        return ", ".join([*keys, *[f"{name} {kind[2]}" for name, kind in self.columns.items()]])

    def per_line(self, lines):
        """The state of each line by itself, for ``merged``; a missing value adds 0 to a sum."""
        needed = [F.col(k).isNotNull() for k in self.keys if k not in self.optional]
        made = {"sum": lambda value: F.coalesce(value, F.lit(0)), "max": lambda value: value}
        return lines.filter(reduce(lambda a, b: a & b, needed)).select(*self.keys, *[
            made[kind](F.expr(value)).cast(type_name).alias(name) for name, (kind, value, type_name) in self.columns.items()
        ])

    def merged(self, old, new):
        """One row per key of either state; a state may have several rows per key, which are added up."""
        names = [*self.keys, *self.columns]
        return old.select(*names).unionByName(new.select(*names)).groupBy(*self.keys).agg(*[
            (F.sum(name) if kind == "sum" else F.max(name)).alias(name)
            for name, (kind, _, _) in self.columns.items()
        ])


_KNOWN = "if(reordered is null, 0, 1)"

USER_STATE = Sums(
    ("user_id",), ("long",),
    {"user_lines": ("sum", "1", "long"), "user_last_order": ("max", "order_number", "int")},
)
NAME_STATE = Sums(
    ("user_id", "product_name"), ("long", "string"),
    {
        "n": ("sum", "1", "long"), "n_known": ("sum", _KNOWN, "long"),
        "reorders": ("sum", "reordered", "long"), "ever_reordered": ("max", "reordered", "int"),
    },
    optional=("product_name",),
)
ORDER_STATE = Sums(
    ("user_id", "order_id"), ("long", "long"),
    {
        "cart_size": ("sum", "if(add_to_cart_order is null, 0, 1)", "long"),
        "days_between": ("max", "days_since_prior_order", "double"),
    },
)
_KEY_TYPES = {"days_since_prior_order": "double", "order_hour_of_day": "int", "order_dow": "int"}
RATE_STATES = {
    name: Sums(
        tuple(keys), tuple(_KEY_TYPES.get(k, "long") for k in keys),
        {"reorders": ("sum", "reordered", "long"), "n_known": ("sum", _KNOWN, "long")},
    )
    for name, keys in RATE_KEYS.items()
}

PAIR_SCHEMA = (
    "user_id long, product_id long, n long, reorders long, position_sum long, position_n long, last_order int, "
    f"first_place {PLACE_TYPE}, last_place {PLACE_TYPE}, run {SUMMARY_TYPE}"
)
_PAIR_SUMS = ("n", "reorders", "position_sum", "position_n")


def pair_state(lines, orders_per_piece=ORDERS_PER_PIECE):
    """Per pair: sums, last order, and the summary of its reorders with its place in the history.

    As in ``pair.user_product_features``, a long history is summarised in pieces.
    """
    known = lines.filter(F.col("user_id").isNotNull() & F.col("product_id").isNotNull())
    known = known.select(*PAIR, *HISTORY_ORDER, "add_to_cart_order", "reordered")
    piece = F.floor(F.coalesce("order_number", F.lit(0)) / F.lit(orders_per_piece))
    orders = by_piece(known, PAIR, piece).groupBy(*PAIR, "piece", *HISTORY_ORDER).agg(
        F.coalesce(F.sum("add_to_cart_order"), F.lit(0)).alias("position_sum"),
        F.count("add_to_cart_order").alias("position_n"),
        *counts("reordered"),
    )
    place = F.struct(*HISTORY_ORDER)
    pieces = orders.groupBy(*PAIR, "piece").agg(
        F.sum(F.col("zeros") + F.col("ones")).alias("n"), F.sum("ones").alias("reorders"),
        F.sum("position_sum").alias("position_sum"), F.sum("position_n").alias("position_n"),
        F.max("order_number").alias("last_order"), F.min(place).alias("first_place"), F.max(place).alias("last_place"),
        summarise(history(HISTORY_ORDER)).alias("run"),
    )
    return pieces.groupBy(*PAIR).agg(
        *[F.sum(c).alias(c) for c in _PAIR_SUMS],
        F.max("last_order").alias("last_order"),
        F.min("first_place").cast(PLACE_TYPE).alias("first_place"), F.max("last_place").cast(PLACE_TYPE).alias("last_place"),
        merge(F.collect_list(F.struct("piece", "run"))).alias("run"),
    )


def late_pairs(old, new):
    """Pairs of ``new`` with a line that does not come after all of theirs in ``old``.

    A line without an order number or id has no place to be sure of.
    """
    before = old.select(*PAIR, F.col("last_place").alias("old_place"))
    place, last = F.col("first_place"), F.col("old_place")
    unsure = [end[c].isNull() for end in (place, last) for c in HISTORY_ORDER]
    return new.join(before, PAIR).filter(reduce(lambda a, b: a | b, unsure) | (place <= last)).select(*PAIR)


def merge_pairs(old, new):
    """One row per pair; where both have it, all lines of ``new`` come later."""
    names = ["user_id", "product_id", *_PAIR_SUMS, "last_order", "first_place", "last_place", "run"]
    both = old.select(*names, F.lit(0).alias("piece")).unionByName(new.select(*names, F.lit(1).alias("piece")))
    return both.groupBy(*PAIR).agg(
        *[F.sum(c).alias(c) for c in _PAIR_SUMS],
        F.max("last_order").alias("last_order"),
        F.min("first_place").alias("first_place"), F.max("last_place").alias("last_place"),
        merge(F.collect_list(F.struct("piece", "run"))).alias("run"),  # at most two of them
    )


def pair_features(pairs, users):
    """``pair.user_product_features`` from the states of pairs and users."""
    joined = lookup_join(pairs, users, ["user_id"], ["product_id"], weights=users, weight="user_lines", how="inner")
    return joined.select(
        *PAIR,
        ratio("n", "user_lines").alias("u_p_order_rate"),
        ratio("reorders", "n").alias("u_p_reorder_rate"),
        ratio("position_sum", "position_n").alias("u_p_avg_position"),
        (F.col("user_last_order") - F.col("last_order")).alias("u_p_orders_since_last"),
        F.col("run.best").cast("int").alias("max_streak"),
    )


def user_features(names, orders):
    """``user.user_features`` from the states of (user, name) and (user, order)."""
    again = F.col("product_name").isNotNull() & (F.col("ever_reordered") == 1)
    by_name = names.groupBy("user_id").agg(
        ratio(F.sum("reorders"), F.sum("n_known")).alias("user_reorder_rate"),
        F.count("product_name").alias("user_unique_products"),
        F.sum("n").alias("user_total_products"),
        F.count_if(again).alias("reordered_names"),
    )
    by_order = orders.groupBy("user_id").agg(
        F.avg("cart_size").alias("user_avg_cart_size"), F.avg("days_between").alias("user_avg_days_between_orders")
    )
    return by_name.join(by_order, "user_id", "left").select(
        "user_id", "user_reorder_rate", "user_unique_products", "user_total_products", "user_avg_cart_size",
        "user_avg_days_between_orders",
        ratio("reordered_names", "user_unique_products").alias("user_reordered_products_ratio"),
    )


def rate_from(state, name):
    """The rate table called ``name`` from its state."""
    return state.select(*RATE_KEYS[name], ratio("reorders", "n_known").alias(name))
