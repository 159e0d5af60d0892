"""Tables laid out by a hash bucket of one key, read and rewritten bucket by bucket.

A bucketed table is Parquet partitioned by ``bucket``. Readers that want a few
users read only their buckets; writers replace only the buckets they touch. The
number of buckets is fixed when the table is first laid out.
"""

from pyspark.sql import functions as F

from trolley.sources.tables import path_exists

BUCKET = "bucket"


def bucket_of(key, n_buckets):
    """The bucket of an id, whatever its integer type; rows without it fall into bucket 0."""
    number = (F.col(key) if isinstance(key, str) else key).cast("long")
    return F.when(number.isNull(), 0).otherwise(F.pmod(F.xxhash64(number), F.lit(n_buckets)).cast("int"))


def with_bucket(df, key, n_buckets):
    """``df`` with the bucket of its key."""
    return df.withColumn(BUCKET, bucket_of(key, n_buckets))


def _write(df, path, parts, mode):
    """Gather a bucket's rows into few files; a large bucket is split over tasks (rebalancing)."""
    writer = df.hint("rebalance", *parts).write.mode("overwrite")
    writer.option("partitionOverwriteMode", mode).partitionBy(*parts).parquet(path)


def write_buckets(df, path, batch=None):
    """Replace the buckets that ``df`` holds and leave the others as they are.

    With ``batch``, the table is partitioned by it first, so writing a batch again
    replaces just that batch.
    """
    if batch is None:
        _write(df, path, [BUCKET], "dynamic")
    else:
        _write(df.withColumn("batch", F.lit(batch)), path, ["batch", BUCKET], "dynamic")


def write_bucketed(df, path, key, n_buckets):
    """Overwrite a whole table, laid out by the buckets of its key."""
    _write(with_bucket(df, key, n_buckets), path, [BUCKET], "static")


def read_buckets(spark, path, schema, buckets=None):
    """Rows of the given buckets, all by default; none if nothing is there yet.

    ``buckets`` is a list of numbers or a column, such as ``wanted_buckets`` gives;
    either way it becomes a partition filter, so other buckets' files stay closed.
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(path)
    if buckets is None:
        return rows
    if isinstance(buckets, list):
        return rows.filter(F.col(BUCKET).isin(buckets))
    return rows.filter(F.array_contains(buckets, F.col(BUCKET)))


def wanted_buckets(users, key, n_buckets):
    """The buckets of a table's users, as a subquery that runs before the scan is planned.

    Its size is bounded by the number of buckets, not of users.
    """
    return with_bucket(users.select(key), key, n_buckets).agg(F.collect_set(BUCKET)).scalar()
