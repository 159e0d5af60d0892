"""Batches merged into feature tables, and serving that reads only its users' buckets."""

import itertools
import os
import random

import pytest
from pyspark.sql import functions as F

from checks.queries import BASKET_QUERIES
from tests.helpers import combined, rows_of
from trolley.operators import pair, rates, recommend, state, user
from trolley.plans import refresh
from trolley.sources.releases import Release
from trolley.sources.buckets import bucket_of, read_buckets, write_buckets


def whole(lines):
    return {
        "user_product_features": pair.user_product_features(lines), "user_features": user.user_features(lines),
        **rates.rate_tables(lines),
    }


def check(spark, folder, lines):
    for name, want in whole(lines).items():
        got = refresh.refreshed(spark, folder, name).select(want.columns)
        assert rows_of(got) == rows_of(want), name


def files(folder, name):
    """Data files of a table by bucket, with what tells a rewritten one."""
    found = {}
    for path, _, names in os.walk(f"{folder}/{name}"):
        for n in names:
            if n.endswith(".parquet"):
                info = os.stat(f"{path}/{n}")
                found.setdefault(os.path.basename(path), set()).add((n, info.st_size, info.st_mtime_ns))
    return found


def random_lines(seed, n):
    """Purchases of a few users, with nulls, repeated lines and names shared by products."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        product, number = rng.choice([None, 1, 2, 3, 4]), rng.choice([None, *range(1, 9)])
        rows.append({
            "user_id": rng.choice([None, 1, 2, 3, 4, 5]), "product_id": product, "product_name": rng.choice(["a", "b", None]),
            "order_id": None if number is None else 100 + number, "order_number": number, "reordered": rng.choice([0, 1, 1, None]),
            "add_to_cart_order": rng.choice([None, 1, 2, 3]), "order_dow": rng.choice([None, 0, 1]),
            "order_hour_of_day": rng.choice([None, 7, 8]), "days_since_prior_order": rng.choice([None, 0.0, 7.0]),
        })
    return rows


def test_random_batches_equal_a_full_recompute(spark, tmp_path):
    """Late, null and repeated lines in any batch; a batch given twice counts once."""
    batches = [random_lines(seed, n) for seed, n in ((1, 60), (2, 25))]
    folder = str(tmp_path / "features")
    for k, rows in enumerate(batches):
        assert refresh.refresh(spark, folder, combined(spark, rows), f"day-{k}", n_buckets=3)
    assert not refresh.refresh(spark, folder, combined(spark, batches[0]), "day-0")
    check(spark, folder, combined(spark, sum(batches, [])))


def test_other_buckets_stay_as_they_are_and_broken_batches_resume(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "features")
    base = [
        {"user_id": u, "product_id": p, "order_id": 10 * u + o, "order_number": o, "reordered": int(o > 1), "days_since_prior_order": 7.0}
        for u, p, o in itertools.product(range(1, 9), (1, 2), (1, 2))
    ]
    refresh.refresh(spark, folder, combined(spark, base), "base", n_buckets=4)
    new = [{"user_id": 3, "product_id": 2, "order_id": 33, "order_number": 3, "reordered": 1, "days_since_prior_order": 2.0}]
    bucket = spark.range(1).select(bucket_of(F.lit(3).cast("long"), 4)).first()[0]
    names = ["user_product_features", "user_features", "u_days_since_prior_order_reorder_rate", "pair_state"]
    before = {name: files(folder, name) for name in names}

    # The batch breaks off after a few of its tables are in place, and is run again.
    written, put = [], refresh.write_buckets

    def breaks(df, path, *rest):
        if len(written) > 2:
            raise OSError("lost")
        written.append(path)
        put(df, path, *rest)

    monkeypatch.setattr(refresh, "write_buckets", breaks)
    with pytest.raises(OSError):
        refresh.refresh(spark, folder, combined(spark, new), "day")
    monkeypatch.setattr(refresh, "write_buckets", put)
    assert refresh.refresh(spark, folder, combined(spark, new), "day")
    check(spark, folder, combined(spark, base + new))
    for name in names:
        after = files(folder, name)
        assert after.keys() == before[name].keys() and len(after) > 1
        assert {b for b in after if after[b] != before[name][b]} == {f"bucket={bucket}"}
    assert not os.path.exists(f"{folder}/staged/day")


def test_empty_batch(spark, tmp_path):
    folder = str(tmp_path / "features")
    rows = combined(spark, random_lines(3, 20))
    refresh.refresh(spark, folder, rows, "base", n_buckets=2)
    assert refresh.refresh(spark, folder, rows.limit(0), "none")
    check(spark, folder, rows)


def test_late_pairs(spark):
    def pairs(*places):
        rows = [{"user_id": 1, "product_id": p, "order_number": n, "order_id": o} for p, n, o in places]
        return state.pair_state(combined(spark, rows))

    old = pairs((1, 5, 50), (2, 5, 50), (3, 5, 50), (4, 5, 50))
    new = pairs((1, 6, 1), (2, 5, 50), (3, 5, 49), (4, None, 60), (9, 1, 1))
    assert rows_of(state.late_pairs(old, new), "product_id") == [(2,), (3,), (4,)]


# --- serving ----------------------------------------------------------------

def scans(df):
    """(files read, partition filters) of every file scan of a plan that has run."""
    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            yield from walk(node.executedPlan())
        elif hasattr(node, "plan") and name.endswith("QueryStageExec"):
            yield from walk(node.plan())
        elif name == "ReusedExchangeExec":
            yield from walk(node.child())
        elif name == "FileSourceScanExec":
            yield node.metrics().apply("numFiles").value(), node.partitionFilters().toString(), node.relation().location().rootPaths().toString()
        children = node.children()
        for k in range(children.size()):
            yield from walk(children.apply(k))

    df.collect()
    return list(walk(df._jdf.queryExecution().executedPlan()))


@pytest.fixture(scope="module")
def served(spark, baskets, tmp_path_factory):
    from checks.queries import serving_tables

    folder = str(tmp_path_factory.mktemp("serving"))
    recommend.publish_serving(spark, serving_tables(baskets), folder, n_buckets=6)
    return Release(spark, folder)


def test_one_user_reads_one_bucket(spark, baskets, served):
    user_id = baskets.train.agg(F.min("user_id")).first()[0]
    one = spark.createDataFrame([(user_id,)], "user_id long")
    for name in recommend.USER_TABLES:
        df = recommend.serving_table(served, name, one)
        found = scans(df)
        path = served.tables[name]["path"]
        buckets = len([d for d in os.listdir(path) if d.startswith("bucket=")])
        assert buckets > 2
        bucket = spark.range(1).select(bucket_of(F.lit(user_id), 6)).first()[0]
        own = [n for n in os.listdir(f"{path}/bucket={bucket}") if n.endswith(".parquet")]
        read, filters, _ = next(x for x in found if name in x[2])
        assert read == len(own) and "bucket" in filters
        want = recommend.serving_table(served, name).filter(bucket_of("user_id", 6) == bucket)
        assert rows_of(df) == rows_of(want)


def test_served_features_equal_those_of_whole_tables(spark, baskets, served):
    want = BASKET_QUERIES["context_features"](baskets)
    users = want.select("user_id").distinct().orderBy("user_id").limit(7).unionByName(spark.createDataFrame([(-1,)], "user_id long"))
    got = recommend.served_features(served, users, "2001-08-02 14:00:00")
    assert rows_of(got) == rows_of(want.join(users, "user_id", "left_semi"))
    assert got.count() > 0


def test_buckets_are_replaced_one_by_one(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "k long, v int, bucket int"
    assert read_buckets(spark, path, schema, [1]).count() == 0
    frame = lambda rows: spark.createDataFrame(rows, schema)
    write_buckets(frame([(1, 1, 0), (2, 2, 1), (3, 3, 2)]), path)
    write_buckets(frame([(9, 9, 1)]), path)
    assert rows_of(read_buckets(spark, path, schema)) == [(1, 1, 0), (3, 3, 2), (9, 9, 1)]
    assert rows_of(read_buckets(spark, path, schema, [1, 2])) == [(3, 3, 2), (9, 9, 1)]
    write_buckets(frame([(1, 1, 0)]), str(tmp_path / "b"), "x")
    write_buckets(frame([(2, 2, 0)]), str(tmp_path / "b"), "y")
    write_buckets(frame([(5, 5, 0)]), str(tmp_path / "b"), "y")
    assert rows_of(spark.read.parquet(str(tmp_path / "b")).select("k")) == [(1,), (5,)]
