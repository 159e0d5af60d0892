"""Joins in which a few keys may hold much of the larger side.

Spark's adaptive execution splits a skewed partition only when both join inputs
come straight from a shuffle. A per-key table that was just aggregated by the
join key does not, so the joins here treat frequent keys themselves.
"""

from functools import reduce

from pyspark.sql import functions as F

# A key is frequent if it holds more rows than an even share of a task, or more
# than this share of all rows. There are at most max(tasks, 1000) frequent keys.
HOT_SHARE = 1 / 1000


def hot_share(df):
    """The share of all rows above which a key is frequent in this session."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(HOT_SHARE, 1 / tasks)


def per_key(df, *keys):
    """Rows per key, as weights for ``lookup_join``."""
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def hot_keys(weights, keys, weight, share=None):
    """Keys whose weight exceeds ``share`` of the total: fewer than 1 / share rows."""
    share = hot_share(weights) if share is None else share
    total = weights.agg(F.sum(weight)).scalar()
    return weights.filter(F.col(weight) > total * F.lit(share)).select(*keys)


def _all_fields(columns):
    return lambda row: {c: row[c] for c in columns}


def lookup_join(
    fact, table, keys, spread, weights, weight, how="left", share=None, read=None
):
    """Join ``table``, one row per key, to ``fact``.

    ``weights`` holds about how many fact rows each key has. The table rows of
    frequent keys are broadcast, at most 1 / share of them; fact rows that found
    theirs there pass the shuffle under a hash of their ``spread`` columns
    instead of the key, so no task receives all of them. All other rows meet by
    key. The weights steer only where rows go, not the result.

    ``read`` maps the matched table row, a struct that is null without a match,
    to the columns wanted from it; by default all but the keys. It is applied
    where a row finds its match, so wide table rows never travel.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be left or inner")
    fields = [c for c in table.columns if c not in keys]
    read = read or _all_fields(fields)
    frequent = F.broadcast(hot_keys(weights, keys, weight, share))
    frequent_rows = table.join(frequent, keys).select(*keys, F.struct(*fields).alias("_row"))
    flagged = fact.join(F.broadcast(frequent_rows), keys, "left")
    served = F.col("_row").isNotNull()
    # Null keys never match and may be many, so they are spread as well.
    unbound = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys], served)
    near = read(F.col("_row"))
    left = flagged.select(
        *fact.columns,
        served.alias("_served"),
        *[value.alias(f"_near_{name}") for name, value in near.items()],
        F.when(unbound, F.hash(*spread)).otherwise(F.hash(*keys)).alias("_place"),
    )
    # A served row may meet its table row once more, which changes nothing.
    right = table.select(*keys, F.hash(*keys).alias("_place"), F.struct(*fields).alias("_row"))
    joined = left.join(right, [*keys, "_place"], "left")
    if how == "inner":
        joined = joined.filter(F.col("_served") | F.col("_row").isNotNull())
    far = read(F.col("_row"))
    return joined.select(
        *fact.columns,
        *[
            F.when(F.col("_served"), F.col(f"_near_{name}")).otherwise(value).alias(name)
            for name, value in far.items()
        ],
    )
