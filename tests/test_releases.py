"""Releases that are seen whole, and raw tables with their bad rows apart."""

import os

import pytest
from pyspark.sql import functions as F

from tests.helpers import rows_of
from trolley.schema import ORDERS, PRODUCTS
from trolley.sources import checked, releases


def test_a_release_that_breaks_off_is_never_seen(spark, tmp_path):
    path = str(tmp_path / "serving")
    with pytest.raises(FileNotFoundError):
        releases.Release(spark, path)
    with releases.NewRelease(spark, path) as new:
        new.write("a", spark.range(3))
        new.write("b", spark.range(5).withColumnRenamed("id", "user_id"), "user_id", 2)
        new.save("m", "weights", lambda model, to: spark.createDataFrame([(model,)], "w string").write.parquet(to))
    first = releases.Release(spark, path)
    running = first.table("a")
    with pytest.raises(ZeroDivisionError):
        with releases.NewRelease(spark, path) as new:
            new.write("a", spark.range(100))
            1 / 0
    again = releases.Release(spark, path)
    assert (again.number, again.rows()) == (1, {"a": 3, "b": 5}) and again.table("b").columns == ["user_id", "bucket"]
    assert spark.read.parquet(again.models["m"]).first()[0] == "weights"
    with releases.NewRelease(spark, path) as new:
        new.write("a", spark.range(7))
    assert releases.Release(spark, path).rows() == {"a": 7} and running.count() == 3
    assert releases.Release(spark, path, 1).table("a").count() == 3


def test_two_writers_cannot_commit_one_number(spark, tmp_path):
    path = str(tmp_path / "serving")
    one, two = releases.NewRelease(spark, path), releases.NewRelease(spark, path)
    one.write("a", spark.range(1))
    two.write("a", spark.range(2))
    one.__exit__(None)
    with pytest.raises(FileExistsError):
        two.__exit__(None)
    assert releases.Release(spark, path).rows() == {"a": 1}


def test_old_releases_go_with_what_broke_off(spark, tmp_path):
    path = str(tmp_path / "serving")
    for n in range(1, 5):
        with releases.NewRelease(spark, path) as new:
            new.write("a", spark.range(n))
    broken = releases.NewRelease(spark, path)
    broken.write("a", spark.range(9))
    releases.drop_old_releases(spark, path, keep=2)
    assert releases.Release(spark, path).rows() == {"a": 4} and releases.Release(spark, path, 3).table("a").count() == 3
    assert sorted(n.split("-")[0] for n in os.listdir(f"{path}/releases")) == ["000000003", "000000004"]


def test_bad_rows_are_set_aside_and_counted(spark, tmp_path):
    (tmp_path / "orders.csv").write_text(
        ",".join(ORDERS.fieldNames()) + "\n1,2,prior,1,0,8,\n2,2,prior,x,0,8,1.0\n3,2,prior\n,2,prior,1,0,8,3.0\n4,5,train,2,1,9,7.0\n"
    )
    table = checked.check_table(spark, str(tmp_path / "orders.csv"), str(tmp_path / "out"), ORDERS)
    assert [r[0] for r in rows_of(table.good)] == [1, 4]
    raw = [r[0] for r in rows_of(table.rejected)]
    assert len(raw) == 3 and any("2,2,prior,x" in x for x in raw) and any("3,2,prior" in x for x in raw)
    assert (table.counts["n_rows"], table.counts["n_rejected"]) == (2, 3)
    assert table.counts["missing"] == {c: int(c == "days_since_prior_order") for c in ORDERS.fieldNames()}
    report = checked.check_report(spark, {"orders": table}).first()
    assert tuple(report) == ("orders", 2, 3, 1)


def test_tables_of_bad_rows_are_refused(spark, tmp_path):
    tables = {"products": ("products", PRODUCTS)}
    (tmp_path / "products.csv").write_text("product_id,product_name,aisle_id,department_id\nx,a,1,2\n")
    with pytest.raises(ValueError, match="empty but for 1 bad"):
        checked.check_tables(spark, str(tmp_path), str(tmp_path / "out"), tables=tables)
    (tmp_path / "products.csv").write_text('product_id,product_name,aisle_id,department_id\nx,a,1,2\n1,"b, ""c""",1,2\n')
    with pytest.raises(ValueError, match="1 bad rows beside 1"):
        checked.check_tables(spark, str(tmp_path), str(tmp_path / "out"), tables=tables, max_rejected=0.4)
    found = checked.check_tables(spark, str(tmp_path), str(tmp_path / "out"), tables=tables)["products"]
    assert rows_of(found.good) == [(1, 'b, "c"', 1, 2)]
    parquet = found.good.withColumn("product_name", F.lit(None).cast("string")).unionByName(found.good)
    parquet.write.parquet(str(tmp_path / "products.parquet"))
    same = checked.check_table(spark, str(tmp_path / "products.parquet"), str(tmp_path / "again"), PRODUCTS, "parquet")
    assert rows_of(same.good) == rows_of(found.good) and same.counts["n_rejected"] == 1
