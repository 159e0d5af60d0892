"""Reading, checking and writing tables."""

import os

import pytest
from pyspark.sql import types as T

from tests.helpers import rows_of
from trolley import session
from trolley.schema import DEPARTMENTS, ORDERS, PRODUCTS, RAW_TABLES
from trolley.sources import tables


def test_csv_keeps_quotes_commas_and_nulls(spark, tmp_path):
    products = spark.createDataFrame(
        [(1, 'say "cheese", please', 1, 2), (2, "it's\\plain", 3, 4)], PRODUCTS
    )
    orders = spark.createDataFrame([(1, 2, "prior", 1, 0, 8, None), (3, 2, "train", 2, 6, 23, 30.0)], ORDERS)
    for name, df, schema in (("products", products, PRODUCTS), ("orders", orders, ORDERS)):
        path = str(tmp_path / name)
        tables.write_table(df, path, "csv")
        assert rows_of(tables.read_table(spark, path, "csv", schema)) == rows_of(df)


def test_published_csv_files_are_read(spark, tmp_path):
    headers = {name: ",".join(schema.fieldNames()) for name, (_, schema) in RAW_TABLES.items()}
    values = {
        "orders": "1,2,prior,1,0,8,", "order_products_prior": "1,3,1,0", "order_products_train": "1,4,1,1",
        "products": '3,"Milk, ""whole""",5,6', "aisles": "5,milk", "departments": "6,dairy eggs",
    }
    for name, (stem, _) in RAW_TABLES.items():
        (tmp_path / f"{stem}.csv").write_text(f"{headers[name]}\n{values[name]}\n")
    loaded = tables.load_tables(spark, str(tmp_path))
    assert loaded["products"].first()["product_name"] == 'Milk, "whole"'
    assert loaded["orders"].first()["days_since_prior_order"] is None
    assert rows_of(tables.validate_tables(loaded))[0] == ("aisles", 1, 2)


def test_empty_table_fails_validation(spark):
    with pytest.raises(ValueError, match="departments is empty"):
        tables.validate_tables({"departments": tables.empty_like(spark, DEPARTMENTS)})


def test_optional_table(spark, tmp_path):
    assert tables.load_optional(spark, str(tmp_path / "Reviews.csv")) is None
    (tmp_path / "Reviews.csv").write_text("id,text\n1,good\n")
    assert rows_of(tables.load_optional(spark, str(tmp_path / "Reviews.csv"))) == [("1", "good")]


def test_prefix_read_takes_matching_suffixes_at_any_depth(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "one.csv").write_text("1\n")
    (tmp_path / "a" / "two.txt").write_text("2\n")
    (tmp_path / "a" / "b" / "three.csv").write_text("3\n")
    (tmp_path / "a" / "b" / "four.json").write_text("4\n")
    assert rows_of(tables.read_prefix(spark, str(tmp_path))) == [("1",), ("2",), ("3",)]
    assert rows_of(tables.read_prefix(spark, str(tmp_path), (".json",))) == [("4",)]


def test_write_replaces_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(spark.range(5), path)
    tables.write_table(spark.range(2), path)
    assert tables.read_table(spark, path).count() == 2


@pytest.mark.parametrize("fmt", ["xml", "CSV"])
def test_unknown_formats_are_refused(spark, fmt):
    with pytest.raises(ValueError, match="format"):
        tables.read_table(spark, "/nowhere", fmt)
    with pytest.raises(ValueError, match="format"):
        tables.write_table(spark.range(1), "/nowhere", fmt)


def test_csv_needs_a_schema(spark):
    with pytest.raises(ValueError, match="schema"):
        tables.read_table(spark, "/nowhere", "csv")


def test_types_are_cast_to_the_schema(spark):
    df = spark.createDataFrame([("1", "x")], "department_id string, department string")
    assert tables.with_schema(df, DEPARTMENTS).schema["department_id"].dataType == T.IntegerType()


class _Context:
    def __init__(self, master, directory=None):
        self.master, self.applicationId, self._directory = master, f"app-{master}", directory

    def getConf(self):
        return self

    def get(self, key, default):
        assert key == "spark.checkpoint.dir"
        return self._directory or default


class _Session:
    def __init__(self, *args):
        self.sparkContext = _Context(*args)


def test_shared_folder_comes_from_the_session():
    assert session.shared_dir(_Session("spark://host:7077", "s3a://shared/x")) == "s3a://shared/x"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(_Session("spark://host:7077"))
    local = session.shared_dir(_Session("local[2]"))
    assert os.path.isdir(local) and session.shared_dir(_Session("local[2]")) == local


def test_intermediate_tables_can_be_removed(spark):
    one, two = session.work_folder(spark, "a"), session.work_folder(spark, "a")
    assert one != two
    spark.range(3).write.parquet(one)
    session.clean(spark)
    assert not os.path.exists(one) and os.path.exists(session.shared_dir(spark))
    session.clean(spark)
