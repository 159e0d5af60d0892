"""Longest run of ones, computed in mergeable pieces.

A run summary is a struct (n, lead, trail, best): elements seen, ones at the
start, ones at the end, longest run. Summaries of neighbouring pieces merge
into the summary of both, so a long history can be summarised piece by piece in
different tasks and no task has to hold it whole.
"""

from pyspark.sql import functions as F

SUMMARY_TYPE = "struct<n:long,lead:long,trail:long,best:long>"

# Order numbers are ints; 2^14 per piece leaves at most 2^17 pieces to merge.
ORDERS_PER_PIECE = 1 << 14


def _summary(n, lead, trail, best):
    return F.struct(
        n.cast("long").alias("n"),
        lead.cast("long").alias("lead"),
        trail.cast("long").alias("trail"),
        best.cast("long").alias("best"),
    )


def _empty():
    zero = F.lit(0)
    return _summary(zero, zero, zero, zero)


def summarise(counts):
    """Summary of an array of structs (sort keys..., zeros, ones), in sorted order.

    Rows that agree in their sort keys count as first the zeros, then the ones.
    """

    def step(acc, item):
        zeros, ones = item["zeros"], item["ones"]
        trail = F.when(zeros > 0, ones).otherwise(acc["trail"] + ones)
        first = (zeros == 0) & (acc["lead"] == acc["n"])
        return _summary(
            acc["n"] + zeros + ones,
            F.when(first, acc["lead"] + ones).otherwise(acc["lead"]),
            trail,
            F.greatest(acc["best"], trail),
        )

    return F.aggregate(F.array_sort(counts), _empty(), step)


def merge(pieces):
    """Summary over an array of structs (piece number, run summary)."""

    def step(acc, item):
        new = item["run"]
        return _summary(
            acc["n"] + new["n"],
            F.when(acc["lead"] == acc["n"], acc["n"] + new["lead"]).otherwise(acc["lead"]),
            F.when(new["trail"] == new["n"], acc["trail"] + new["n"]).otherwise(new["trail"]),
            F.greatest(acc["best"], new["best"], acc["trail"] + new["lead"]),
        )

    return F.aggregate(F.array_sort(pieces), _empty(), step)


def counts(flag):
    """Aggregates: rows whose flag is not 1, and rows whose flag is 1."""
    ones = F.count_if(F.col(flag) == 1)
    return (F.count("*") - ones).alias("zeros"), ones.alias("ones")


def history(order):
    """Aggregate: a group's ``counts`` with their sort keys, as ``summarise`` takes them."""
    return F.collect_list(F.struct(*order, "zeros", "ones"))


def by_piece(df, keys, piece):
    """Rows with the number of their piece, dealt by key and piece.

    One exchange then serves the aggregate per order and the one per piece, and a
    key that holds many rows still goes to as many tasks as it has pieces.
    """
    return df.withColumn("piece", piece).repartition(*keys, "piece")


def longest_run(df, keys, order, flag, piece):
    """Per key, the longest run of ``flag = 1`` in ``order``.

    ``piece`` numbers the bounded pieces a key's history is cut into; it must
    not decrease along ``order``. Rows that agree in key and order are counted
    first, so a piece is as short as it has different places in the order.
    """
    placed = by_piece(df, keys, piece)
    counted = placed.groupBy(*keys, "piece", *order).agg(*counts(flag))
    pieces = counted.groupBy(*keys, "piece").agg(summarise(history(order)).alias("run"))
    return pieces.groupBy(*keys).agg(
        merge(F.collect_list(F.struct("piece", "run")))["best"].alias("longest_run")
    )
