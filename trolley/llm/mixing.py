"""Mixing sources to target weights by capped water-filling.

Every source gets a share of the words by its weight, but never more than
``max_epochs`` times what it has: sources above that are clamped and what they
leave is dealt to the others by weight, until none is above. A document is taken
``floor(epochs)`` whole times, and once more if it falls into the seeded sample
that fills the fraction.

The sample walks the documents of a source in the order of a keyed digest and
takes those whose middle lies before the wanted number of words, so the words
taken differ from the target by at most half of one document. The running total
is exact but no task sees a whole source: digests fall into ``LANES`` lanes of
equal width, totals run over the lanes first and then inside each lane.

Edge cases: a null source is a source of its own, last in order; a null or empty
text has size 0 and is taken only in whole repetitions; sources without words
get target 0; an empty table gives an empty result. Rows with the same doc_id
and size are taken equally often. Other columns of the input are kept by
``mix_documents`` whatever their names.
"""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trolley.llm.common import stored, word_count

LANES = 1024
SALTS = 32
WEIGHTS = (5, 2, 1)


def source_weights(sizes, weights=WEIGHTS):
    """Weights, repeating, for the sources in code-point order with null last.

    The order number is counted within range partitions and then shifted by the
    rows of the partitions before, so no task gets all sources.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = stored(
        totals.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id()),
        "mix_sources",
    )
    before = placed.groupBy("part").agg(F.count("*").alias("n")).select(
        "part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("before")
    )
    inside = F.row_number().over(W.partitionBy("part").orderBy(F.col("source").asc_nulls_last()))
    numbered = placed.withColumn("inside", inside).join(before, "part")
    place = (F.col("before") + F.col("inside") - 1) % len(weights)
    return numbered.select("source", "source_size", F.array(*map(F.lit, weights))[place.cast("int")].alias("weight"))


def targets(weighted, max_epochs=3):
    """Add ``target``: capped water-filling over all words of the sources.

    The level, words per weight, starts with no source clamped and rises each
    time more are. A round is one pass over the sources; two totals of it come to
    the driver.
    """
    cap = F.col("source_size") * max_epochs
    total, share = weighted.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.sum("weight")).first()
    left, weight = total, F.col("weight").cast("long")  # times the words left, beyond 32 bits
    while share:
        over = weight * F.lit(left) > cap * F.lit(share)
        clamped, free = weighted.agg(F.sum(F.when(over, cap)), F.sum(F.when(~over, weight))).first()
        if free == share:
            return weighted.withColumn(
                "target", F.when(over, cap.cast("double")).otherwise(weight * F.lit(left) / F.lit(share))
            )
        left, share = total - (clamped or 0), free
    return weighted.withColumn("target", cap.cast("double"))


def with_digest(rows, seed):
    """Add ``digest``, 32 bits from the md5 of the seed and the doc_id."""
    text = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return rows.withColumn("digest", F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long"))


def plan(sizes, weights=WEIGHTS, max_epochs=3, seed=7):
    """One row per source: its size, target, whole times, and where the extra sample ends.

    ``sizes`` has doc_id, source and size. A document is in the extra sample if
    (digest, doc_id, size) comes before or at (cut_digest, cut_id, cut_size).
    """
    filled = stored(targets(stored(source_weights(sizes, weights), "mix_weights"), max_epochs), "mix_targets")
    epochs = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    filled = filled.withColumn("whole", F.floor(epochs)).withColumn(
        "wanted", F.col("target") - F.col("whole") * F.col("source_size")
    ).drop("weight")
    dealt = with_digest(sizes, seed).withColumn("lane", F.floor(F.col("digest") / (2**32 // LANES)))
    before = W.partitionBy("source").orderBy("lane").rowsBetween(W.unboundedPreceding, -1)
    lanes = dealt.groupBy("source", "lane").agg(F.sum("size").alias("in_lane")).withColumn(
        "lane_start", F.coalesce(F.sum("in_lane").over(before), F.lit(0))
    )
    right = filled.select(F.col("source").alias("f_source"), "wanted")
    last = lanes.join(right, F.col("source").eqNullSafe(F.col("f_source"))).filter(
        (F.col("lane_start") < F.col("wanted")) & (F.col("lane_start") + F.col("in_lane") >= F.col("wanted"))
    ).select("f_source", F.col("lane").alias("f_lane"), "lane_start", "wanted")
    inside = W.partitionBy("f_source").orderBy("digest", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    middle = F.col("lane_start") + F.coalesce(F.sum("size").over(inside), F.lit(0)) + F.col("size") / 2
    cut = F.max(F.when(F.col("taken"), F.struct("digest", _known("doc_id").alias("id"), "size")))
    ends = dealt.join(
        last, F.col("source").eqNullSafe(F.col("f_source")) & (F.col("lane") == F.col("f_lane"))
    ).withColumn("taken", middle <= F.col("wanted")).groupBy("f_source", "f_lane").agg(cut.alias("cut"))
    found = filled.join(ends, F.col("source").eqNullSafe(F.col("f_source")), "left").select(
        "source", "source_size", "target", "whole",
        F.coalesce(F.col("cut.digest"), F.col("f_lane") * (2**32 // LANES), F.lit(0)).alias("cut_digest"),
        F.col("cut.id").alias("cut_id"), F.col("cut.size").alias("cut_size"),
    )
    return stored(found, "mix_plan")


def _with_plan(rows, found, seed):
    """Rows with their source's plan; a hot source's rows are dealt over ``SALTS`` places."""
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    found = found.withColumnRenamed("source", "p_source").withColumn("p_salt", salts)
    salted = with_digest(rows, seed).withColumn("salt", F.pmod("digest", F.lit(SALTS)).cast("int"))
    return salted.join(found, F.col("source").eqNullSafe(F.col("p_source")) & (F.col("salt") == F.col("p_salt")))


def _known(name):
    """The id, with the smallest number for null."""
    return F.coalesce(F.col(name).cast("long"), F.lit(-(2**63)))


def _times(doc_id, size):
    at = F.struct("digest", _known(doc_id).alias("id"), F.col(size).alias("size"))
    end = F.struct(F.col("cut_digest").alias("digest"), F.col("cut_id").alias("id"), F.col("cut_size").alias("size"))
    first = F.when(F.col("cut_id").isNull(), F.col("digest") < F.col("cut_digest")).otherwise(at <= end)
    return (F.col("whole") + (first & (F.col(size) > 0)).cast("long")).cast("long")


def mix_sizes(docs, weights=WEIGHTS, max_epochs=3, seed=7):
    """How often each document is taken; the texts are read once, for their sizes."""
    sizes = stored(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "mix_sizes")
    joined = _with_plan(sizes, plan(sizes, weights, max_epochs, seed), seed)
    return joined.select(
        "doc_id", "source", "size", "source_size", "target", _times("doc_id", "size").alias("times")
    )


def mix_documents(docs, weights=WEIGHTS, max_epochs=3, seed=7):
    """The mixed corpus: each row of ``docs`` as often as it is taken.

    The sample is a cut per source, so texts meet only the small table of
    sources and need not move.
    """
    sizes = stored(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "mix_sizes")
    found = plan(sizes, weights, max_epochs, seed)
    rows = docs.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"), F.struct(*[docs[c] for c in docs.columns]).alias("row")
    )
    joined = _with_plan(rows, found, seed)
    taken = joined.withColumn("times", _times("doc_id", "size")).filter("times > 0")
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).select("row.*")
