"""What the operators share: input tables, stored stages, column names."""

from pyspark.sql import functions as F

from trolley.session import work_folder

# Words as every operator here takes them: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

ARROW_BYTES = 4 << 20


def table(spark, folder, name):
    """One table of a data folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scratch(spark, name):
    """A new path below the shared folder, there until ``session.clean``; no two calls return the same."""
    return work_folder(spark, name)


def stored(df, name):
    """Write ``df`` below the shared folder and read it back.

    This cuts the lineage: a lost executor costs its own tasks, and a table used
    twice is computed once.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark):
    """Let Arrow batches hold at most ``ARROW_BYTES``, so that workers and buffers do not grow with long rows.

    The session's setting is only ever lowered. A single longer row is a batch of its own.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = spark.conf.get(name)
    if not held.rstrip("b").isdigit() or int(held.rstrip("b")) > ARROW_BYTES:
        spark.conf.set(name, ARROW_BYTES)


def fresh(df, *names):
    """The names, each with underscores in front until no column is called so."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


def word_count(text):
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
