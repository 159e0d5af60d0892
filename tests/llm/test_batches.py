"""Arrow batches of the operators on texts are bounded in bytes, not in rows."""

import pyarrow as pa
from pyspark.sql import functions as F

from trolley.llm import common, near_duplicates, toxicity

SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def _largest(docs):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.nbytes]})

    return docs.coalesce(1).select("text").mapInArrow(sizes, "n long").agg(F.max("n")).first()[0]


def test_batches_of_long_texts_are_small(spark):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.repeat(F.concat(F.col("id"), F.lit(" word ")), 9000).alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).alias("toxic"))
    for use in (
        lambda: near_duplicates.near_duplicates(docs.limit(3)),
        lambda: toxicity.learn(docs.limit(3), labels),
        lambda: toxicity.score(docs.limit(3), (0.0, [], [])),
    ):
        spark.conf.unset(SETTING)
        assert _largest(docs) > 4 * common.ARROW_BYTES
        use()
        assert _largest(docs) < 1.5 * common.ARROW_BYTES
    spark.conf.set(SETTING, 1000)
    common.small_batches(spark)
    assert spark.conf.get(SETTING).rstrip("b") == "1000"
    spark.conf.unset(SETTING)
