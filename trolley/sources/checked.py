"""Raw tables parsed once, with bad rows set aside and counted."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from trolley.schema import RAW_TABLES
from trolley.sources.tables import read_table

RAW_LINE, REJECTED = "_raw_line", "_rejected"


def _flagged(spark, path, schema, fmt):
    """Rows with ``_rejected``: unreadable ones, and ones without a value that the schema demands."""
    if fmt == "csv":
        wanted = T.StructType([*schema.fields, T.StructField(RAW_LINE, T.StringType())])
        rows = spark.read.schema(wanted).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RAW_LINE).csv(
            path, header=True, quote='"', escape='"', enforceSchema=True
        )
    else:
        rows = read_table(spark, path, fmt).select(*schema.fieldNames(), F.lit(None).cast("string").alias(RAW_LINE))
    bad = F.col(RAW_LINE).isNotNull()
    for f in schema.fields:
        bad |= F.lit(not f.nullable) & F.col(f.name).isNull()
    told = F.coalesce(F.col(RAW_LINE), F.to_json(F.struct(*schema.fieldNames())))
    return rows.withColumn(REJECTED, bad).withColumn(RAW_LINE, F.when(bad, told))


class CheckedTable:
    """A raw table that was written with its bad rows apart: ``good``, ``rejected`` and ``counts``.

    ``counts`` has n_rows and n_rejected, and for every column the missing values
    of the good rows. They come from one pass over the columns written, so the raw
    files are parsed only once.
    """

    def __init__(self, spark, path, schema):
        types = T.StructType([*schema.fields, T.StructField(RAW_LINE, T.StringType()), T.StructField(REJECTED, T.BooleanType())])
        rows = spark.read.schema(types).parquet(path)
        self.good = rows.filter(~F.col(REJECTED)).select(*schema.fieldNames())
        self.rejected = rows.filter(F.col(REJECTED)).select(F.col(RAW_LINE).alias("raw_line"))
        missing = [F.count_if(~F.col(REJECTED) & F.col(c).isNull()).alias(c) for c in schema.fieldNames()]
        found = rows.agg(F.count("*").alias("_n"), F.count_if(REJECTED).alias("_bad"), *missing).first()
        self.counts = {
            "n_rows": found["_n"] - found["_bad"], "n_rejected": found["_bad"],
            "missing": {c: found[c] for c in schema.fieldNames()},
        }


def check_table(spark, source, target, schema, fmt="csv"):
    """Copy a raw table to ``target`` as Parquet in one pass, bad rows in a partition of their own."""
    flagged = _flagged(spark, source, schema, fmt)
    flagged.write.mode("overwrite").partitionBy(REJECTED).parquet(target)
    return CheckedTable(spark, target, schema)


def check_tables(spark, path, target, fmt="csv", tables=RAW_TABLES, max_rejected=None):
    """All raw tables, checked; raises for a table without good rows.

    ``max_rejected`` is the share of bad rows from which on a table is refused.
    """
    found = {}
    for name, (stem, schema) in tables.items():
        table = check_table(spark, f"{path}/{stem}.{fmt}", f"{target}/{name}", schema, fmt)
        good, bad = table.counts["n_rows"], table.counts["n_rejected"]
        if not good:
            raise ValueError(f"table {name} is empty" + (f" but for {bad} bad rows" if bad else ""))
        if max_rejected is not None and bad > max_rejected * (good + bad):
            raise ValueError(f"table {name} has {bad} bad rows beside {good} good ones")
        found[name] = table
    return found


def check_report(spark, checked):
    """One row per table: good and bad rows, and the missing values of the good ones."""
    rows = [(n, t.counts["n_rows"], t.counts["n_rejected"], sum(t.counts["missing"].values())) for n, t in checked.items()]
    return spark.createDataFrame(rows, "table_name string, n_rows long, n_rejected long, n_missing long")
