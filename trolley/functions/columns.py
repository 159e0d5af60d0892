"""Scalar expressions; everything here stays a native Spark column."""

from itertools import chain

from pyspark.sql import functions as F


def rate(column):
    """Share of rows whose 0/1 column is 1; null when there are no rows."""
    return F.avg(column)


def ratio(numerator, denominator):
    """Division that gives null, not an error, for a zero denominator."""
    return F.try_divide(
        F.col(numerator).cast("double") if isinstance(numerator, str) else numerator.cast("double"),
        F.col(denominator) if isinstance(denominator, str) else denominator,
    )


def contains_flag(column, text):
    """1 if the text occurs in the column, ignoring case; null counts as 0."""
    return F.coalesce(F.lower(column).contains(text.lower()), F.lit(False)).cast("int")


def equals_flag(column, value):
    """1 if the column has this value; null counts as 0."""
    return F.coalesce(F.col(column) == F.lit(value), F.lit(False)).cast("int")


def title_case(column):
    """Capital first letter in every run of letters, as in ``It'S Co-Op``."""
    runs = F.regexp_extract_all(F.col(column), F.lit(r"\p{L}+|\P{L}+"), F.lit(0))
    return F.array_join(F.transform(runs, F.initcap), "")


def lookup(column, mapping, default=None):
    """Value of a small fixed mapping, or the default for other keys."""
    key = F.col(column) if isinstance(column, str) else column
    pairs = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    # A null key has no entry and must not reach the map access.
    found = F.when(key.isNotNull(), F.try_element_at(pairs, F.coalesce(key, F.lit(next(iter(mapping))))))
    return F.coalesce(found, F.lit(default)) if default is not None else found


def round_even(column, digits):
    """Round half to even, the rule numpy and pandas use."""
    return F.bround(column, digits)


def first_match(rules, otherwise):
    """Value of the first (condition, value) rule that holds."""
    chosen = None
    for condition, value in rules:
        value = F.lit(value)
        chosen = F.when(condition, value) if chosen is None else chosen.when(condition, value)
    return chosen.otherwise(F.lit(otherwise))


def week_day(timestamp):
    """Day of week, 0 for Sunday to 6 for Saturday."""
    return (F.dayofweek(timestamp) - 1).cast("int")


def key_hash_below(share, seed, *keys):
    """True for a fixed ``share`` of the keys, chosen by their MD5 hash.

    The choice depends on the key alone, so it needs no shuffle and survives
    repartitioning and recomputation. ``share`` is resolved to 1/2^32.
    """
    if not 0 <= share <= 1:
        raise ValueError("share must lie in [0, 1]")
    if share == 1:
        return F.lit(True)
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed)))
    limit = f"{int(share * 2**32):08x}"
    return F.substring(F.md5(text), 1, 8) < F.lit(limit)
