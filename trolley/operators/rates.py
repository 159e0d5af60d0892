"""Reorder-rate tables and their profiles.

Each table holds the mean of ``reordered`` over prior lines per key; lines with
a null key are left out.
"""

from functools import reduce

from pyspark.sql import functions as F

from trolley.functions.joins import lookup_join

# Table name (also its value column) -> keys.
RATE_KEYS = {
    "hour_reorder_rate": ["product_id", "order_hour_of_day"],
    "day_reorder_rate": ["product_id", "order_dow"],
    "p_days_since_prior_order_reorder_rate": ["product_id", "days_since_prior_order"],
    "u_days_since_prior_order_reorder_rate": ["user_id", "days_since_prior_order"],
    "days_since_prior_reorder_rate": ["user_id", "product_id", "days_since_prior_order"],
}


def rate_table(prior, name):
    """The rate table called ``name``."""
    keys = RATE_KEYS[name]
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return prior.filter(present).groupBy(*keys).agg(F.avg("reordered").alias(name))


def rate_tables(prior):
    """All five tables by name."""
    return {name: rate_table(prior, name) for name in RATE_KEYS}


def rate_profile(table, key, name, first=None):
    """Unweighted mean of a rate table per value of one key, keys ascending.

    ``first`` keeps only that many of the smallest keys.
    """
    profile = table.groupBy(key).agg(F.avg(name).alias(f"mean_{name}")).orderBy(key)
    return profile.limit(first) if first else profile


def hour_profile(prior):
    """Mean product reorder rate by hour."""
    name = "hour_reorder_rate"
    return rate_profile(rate_table(prior, name), "order_hour_of_day", name)


def day_profile(prior):
    """Mean product reorder rate by day of week."""
    name = "day_reorder_rate"
    return rate_profile(rate_table(prior, name), "order_dow", name)


def gap_profile(prior, first=30):
    """Mean user-product reorder rate for the smallest day gaps."""
    name = "days_since_prior_reorder_rate"
    return rate_profile(rate_table(prior, name), "days_since_prior_order", name, first)


def mean_reorder_gap(user_rates):
    """Mean day gap over the rows of the user rate table, unweighted."""
    return user_rates.agg(F.avg("days_since_prior_order").alias("mean_reorder_gap"))


def product_rate_maps(rates):
    """The three product rate tables as one row per product holding three maps.

    One join on ``product_id`` then serves all three look-ups. A map has at most
    one entry per hour, week day or whole-day gap.
    """
    hour, day, gap = ("hour_reorder_rate", "day_reorder_rate", "p_days_since_prior_order_reorder_rate")
    long_form = reduce(
        lambda a, b: a.unionByName(b),
        [
            rates[name].select(
                "product_id",
                F.lit(name).alias("kind"),
                F.col(RATE_KEYS[name][1]).cast("double").alias("at"),
                F.col(name).alias("value"),
            )
            for name in (hour, day, gap)
        ],
    )

    def entries(name):
        entry = F.when(F.col("kind") == name, F.struct("at", "value"))
        return F.map_from_entries(F.collect_list(entry)).alias(f"{name}_map")

    return long_form.groupBy("product_id").agg(entries(hour), entries(day), entries(gap))


def _rate_at(rates, key):
    """Entry of a rate map at a column's value; 0 if there is none."""
    value = F.try_element_at(rates, F.coalesce(F.col(key).cast("double"), F.lit(-1.0)))
    return F.coalesce(F.when(F.col(key).isNotNull(), value), F.lit(0.0))


def attach_product_rates(df, rates, weights):
    """Add the three product rates for the row's hour, day and gap; 0 if none.

    ``weights`` counts the rows per product (``per_key``).
    """
    names = ["hour_reorder_rate", "day_reorder_rate", "p_days_since_prior_order_reorder_rate"]

    def read(row):
        return {name: _rate_at(row[f"{name}_map"], RATE_KEYS[name][1]) for name in names}

    return lookup_join(
        df, product_rate_maps(rates), ["product_id"], ["user_id"], weights, "n", read=read
    )


def attach_user_rate(contexts, rates):
    """Add the user's rate at the context's day gap to a per-user table; 0 if none."""
    name = "u_days_since_prior_order_reorder_rate"
    return contexts.join(rates[name], RATE_KEYS[name], "left").fillna(0.0, [name])


def pair_rates_at(contexts, rates):
    """The pair rate at each user's day gap, one row per pair that has one."""
    name = "days_since_prior_reorder_rate"
    gaps = contexts.select("user_id", "days_since_prior_order")
    return (
        rates[name]
        .join(gaps, ["user_id", "days_since_prior_order"])
        .select("user_id", "product_id", name)
    )
