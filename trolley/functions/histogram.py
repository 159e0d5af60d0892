"""Equal-width histograms."""

from pyspark.sql import functions as F


def histogram(df, column, bins):
    """Count per bin over [min, max], the last bin closed; empty bins count 0.

    Equal bounds are widened by 0.5 each way; nulls are left out. The bounds are
    a scalar subquery, so it all stays one query.
    """
    values = df.select(F.col(column).cast("double").alias("value")).filter(
        F.col("value").isNotNull()
    )
    low, high = F.min("value"), F.max("value")
    margin = F.when(low == high, 0.5).otherwise(0.0)
    bounds = values.agg(F.struct((low - margin).alias("low"), (high + margin).alias("high"))).scalar()
    low, width = bounds["low"], (bounds["high"] - bounds["low"]) / F.lit(bins)
    position = F.floor((F.col("value") - low) / width)
    counts = values.groupBy(F.least(position, F.lit(bins - 1)).cast("int").alias("bin")).agg(
        F.count("*").alias("n")
    )
    all_bins = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return all_bins.join(counts, "bin", "left").select(
        "bin",
        (low + (F.col("bin") + F.lit(0.5)) * width).alias("bin_centre"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )
