"""Few rows are fitted within one task, by the same steps as many."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.helpers import rows_of
from trolley.operators import boosting, models, network
from trolley.schema import LABEL

COLUMNS = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def parts(spark):
    def noise(salt):
        return F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(100)) / 100

    ids = spark.range(900, numPartitions=3).withColumns({c: noise(i) for i, c in enumerate(COLUMNS[:3])}).withColumn("d", F.lit(2.0))
    rows = ids.withColumn(LABEL, (noise(9) < F.col("a") * F.col("c")).cast("double")).select(
        (F.col("id") % 30).alias("user_id"), F.col("id").alias("product_id"), *COLUMNS, LABEL
    )
    return rows.filter("product_id % 5 > 0"), rows.filter("product_id % 5 = 0")


def both(monkeypatch, module, fit):
    jobs = []
    plain = boosting.Grower._summed
    monkeypatch.setattr(boosting.Grower, "_summed", lambda *a, **k: jobs.append(1) or plain(*a, **k))
    few = fit()
    assert not jobs
    monkeypatch.setattr(module, "FEW_ROWS", 0)
    return few, fit()


@pytest.mark.parametrize("held", [True, False])
@pytest.mark.parametrize("kind", ["fit_oblivious_trees", "fit_free_trees"])
def test_trees_are_the_same(monkeypatch, parts, kind, held):
    monkeypatch.setattr(boosting, "TREES_TOLD", 2)
    validation = parts[1] if held else None
    few, many = both(monkeypatch, boosting, lambda: getattr(boosting, kind)(
        parts[0], validation, rounds=5, depth=4, step=0.4, n_bins=16, patience=2, columns=COLUMNS
    ))
    assert len(few.trees) == len(many.trees) > 0 and few.history == many.history and few.gains == many.gains
    for a, b in zip(few.trees, many.trees):
        assert (a.feature, a.bin, a.left, a.right, a.values) == (b.feature, b.bin, b.left, b.right, b.values)


def test_splits_of_many_nodes_are_found_in_turns(monkeypatch, parts):
    fit = lambda: boosting.fit_oblivious_trees(parts[0], rounds=2, depth=4, step=0.4, n_bins=16, columns=COLUMNS)
    whole = fit()
    rows = [boosting.pa.RecordBatch.from_arrays(
        [boosting.pa.array([bytes([i % 7, i % 3]) for i in range(90)], boosting.pa.binary()), boosting.pa.array([float(i % 2) for i in range(90)]),
         boosting.pa.array([False] * 90), boosting.pa.array([0.0] * 90)], names=["bins", "label", "held", "margin"]
    )]
    trees = []
    for at_once in (1 << 13, 3):
        monkeypatch.setattr(boosting, "NODES_AT_ONCE", at_once)
        grower = boosting.FewRows(rows, [[1.0, 2.0, 3.0, 4.0, 5.0, 6.0], [1.0, 2.0]], 0.0, 1.0, 0.3, 0.0)
        trees.append([boosting._grow(grow, grower, 2, 4, 1.0, 9, 1, False) for grow in (boosting._oblivious_tree, boosting._free_tree)])
    assert trees[0] == trees[1] and len(whole.trees) == 2


def test_many_leaves_are_no_literals(monkeypatch, parts):
    model = boosting.fit_oblivious_trees(parts[0], rounds=3, depth=3, step=0.4, n_bins=16, columns=COLUMNS)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    native = models.score(model, parts[1])
    rows = rows_of(native, "product_id", "p")
    assert "Python" not in plan(native)
    monkeypatch.setattr(boosting, "NATIVE_VALUES", 23)
    assert "Python" in plan(models.score(model, parts[1]))
    assert np.allclose(rows, rows_of(models.score(model, parts[1]), "product_id", "p"), atol=1e-12)


@pytest.mark.parametrize("held", [True, False])
def test_networks_are_the_same(monkeypatch, parts, held):
    validation = parts[1] if held else None
    few, many = both(monkeypatch, network, lambda: network.fit_network(
        parts[0], validation, hidden=(6, 4), dropout=0.2, rate=0.03, epochs=3, steps=4, columns=COLUMNS
    ))
    assert np.allclose(few.vector, many.vector, atol=1e-9) and np.allclose(few.history, many.history, atol=1e-9)
    assert len(few.history) == (3 if held else 0)


def test_the_network_takes_all_steps(monkeypatch, parts):
    asked, plain = [], network._steps
    monkeypatch.setattr(network, "FEW_ROWS", 0)
    monkeypatch.setattr(network, "_mean_gradient", lambda rows, vector, *a: asked.append(a[1]) or (np.zeros(len(vector)), 1))
    network.fit_network(parts[0], None, hidden=(2,), epochs=2, steps=3, columns=COLUMNS)
    assert asked == [0, 0, 0, 1, 1, 1] and plain is network._steps
