"""Read, check and write tables as CSV or Parquet on any Hadoop file system."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trolley.schema import RAW_TABLES

FORMATS = ("csv", "parquet")


def read_table(spark, path, fmt="parquet", schema=None):
    """Read one table; CSV needs its schema, nothing is inferred."""
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}, not {fmt!r}")
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        if schema is None:
            raise ValueError("reading CSV needs a schema")
        # Names may hold quotes, which the files double rather than backslash.
        return reader.csv(path, header=True, quote='"', escape='"')
    return reader.parquet(path)


def write_table(df, path, fmt="parquet", **options):
    """Overwrite the table at ``path``; further options go to the writer."""
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}, not {fmt!r}")
    writer = df.write.mode("overwrite").options(**options)
    if fmt == "csv":
        writer.csv(path, header=True, quote='"', escape='"')
    else:
        writer.parquet(path)


def locate(spark, path):
    """A Hadoop path and its file system."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark, path):
    """Whether a file or folder is there, on whichever file system it names."""
    hadoop_path, fs = locate(spark, path)
    return fs.exists(hadoop_path)


def remove_path(spark, path):
    """Remove a folder that this package wrote, with all below it."""
    hadoop_path, fs = locate(spark, path)
    fs.delete(hadoop_path, True)


def load_tables(spark, path, fmt="csv"):
    """Read the six raw tables from ``path`` into a name -> DataFrame dict."""
    return {
        name: read_table(spark, f"{path}/{stem}.{fmt}", fmt, schema)
        for name, (stem, schema) in RAW_TABLES.items()
    }


def load_optional(spark, path, fmt="csv", schema=None):
    """Read a table that may be absent; ``None`` when it is."""
    if not path_exists(spark, path):
        return None
    if fmt == "csv" and schema is None:
        # The optional table's columns are unknown: keep the header, all strings.
        return spark.read.csv(path, header=True, quote='"', escape='"')
    return read_table(spark, path, fmt, schema)


def read_prefix(spark, path, suffixes=(".csv", ".txt"), schema=None):
    """Rows of every file below ``path``, however deep, that ends in a suffix."""
    glob = "*{" + ",".join(suffixes) + "}"
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    if schema is None:
        return reader.text(path)
    return reader.schema(schema).csv(path, header=True, quote='"', escape='"')


def table_sizes(tables):
    """One row per table: its name, rows and columns."""
    parts = [
        df.agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("table_name"),
            "n_rows",
            F.lit(len(df.columns)).alias("n_columns"),
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def validate_tables(tables):
    """Raise if any table is empty, else report the sizes."""
    for name, df in tables.items():
        if df.isEmpty():
            raise ValueError(f"table {name} is empty")
    return table_sizes(tables)


def publish(tables, path):
    """Write each table to its own folder below ``path``; return the folders."""
    folders = {name: f"{path}/{name}" for name in tables}
    for name, df in tables.items():
        write_table(df, folders[name])
    return folders


def with_schema(df, schema):
    """Columns and types of ``schema``, in its order."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def empty_like(spark, schema: T.StructType):
    """A table with this schema and no rows."""
    return spark.createDataFrame([], schema)
