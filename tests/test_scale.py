"""Tasks that do not grow with the input."""

from pyspark.sql import functions as F

from tests.helpers import rows_of
from trolley import session
from trolley.functions.joins import lookup_join, per_key
from trolley.sources import star
from trolley.sources.tables import read_table, write_table


def test_shuffles_and_scans_get_tasks_by_rows(spark, settings, tmp_path):
    settings(spark__sql__shuffle__partitions="4", spark__sql__files__minPartitionNum="4")
    session.widen(spark, 3 * session.ROWS_PER_TASK)
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
    session.widen(spark, 9 * session.ROWS_PER_TASK + 1)
    assert spark.conf.get("spark.sql.shuffle.partitions") == "10"
    assert spark.conf.get("spark.sql.files.minPartitionNum") == "10"
    # One file of many small row groups is read by many tasks.
    settings(spark__sql__files__openCostInBytes="1024")
    rows = spark.range(200_000).select(F.xxhash64("id").alias("x")).coalesce(1)
    write_table(rows, str(tmp_path / "rows"), **{"parquet.block.size": 1 << 16})
    read = read_table(spark, str(tmp_path / "rows"))
    sizes = [r["count"] for r in read.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 200_000 and len(sizes) >= 8 and max(sizes) < 50_000


def test_lookup_join_moves_keys_once(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    fact = spark.range(500).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    table = spark.range(0, 7, 2).select(F.col("id").alias("k"), (F.col("id") * 3).alias("x"))
    joined = lookup_join(fact, table, ["k"], ["v"], per_key(fact, "k"), "n")
    assert "_k" not in joined._jdf.queryExecution().analyzed().toString()
    assert rows_of(joined) == rows_of(fact.join(table, "k", "left").select("k", "v", "x"))


def test_reordered_lines_with_stored_first_orders(spark):
    placed = spark.createDataFrame(
        [(10, 1, 7, 1, 1, "prior"), (11, 1, 7, 1, 2, "prior"), (12, 2, 7, 1, 1, "train")],
        "order_id long, user_id long, product_id long, add_to_cart_order int, order_number int, eval_set string",
    )
    got = rows_of(star.with_reordered(placed, star.first_orders(placed)))
    assert got == rows_of(star.with_reordered(placed)) and [r[3] for r in sorted(got)] == [0, 1, 0]
