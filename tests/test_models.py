"""Factors and classifiers: checked by quality and invariants, not by values."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.helpers import rows_of
from trolley.operators import models, product, training
from trolley.operators.factors import factorise, pattern_factors, row_factors
from trolley.schema import LABEL, MODEL_FEATURES

FLAGS = {
    "name_large": ("name_contains", "large"), "aisle_4": ("aisle_id", 4),
    "department_0": ("department_id", 0), "department_2": ("department_id", 2),
}


def test_factorisation_error_never_rises(spark):
    rng = np.random.default_rng(1)
    x = np.unique(rng.integers(0, 2, (30, 6)), axis=0)
    patterns = spark.createDataFrame([("".join(map(str, r)), int(n)) for r, n in zip(x, rng.integers(1, 9, len(x)))], "pattern string, n long")
    columns, errors = factorise(patterns, 6, 3, 42, rounds=6)
    assert len(errors) == 6 and all(b <= a + 0.05 for a, b in zip(errors, errors[1:])) and errors[-1] < errors[0]
    again, same = factorise(patterns.repartition(5), 6, 3, 42, rounds=6)
    assert (again == columns).all() and same == errors


def test_row_factors_are_the_best_ones():
    rng = np.random.default_rng(2)
    columns, x = rng.uniform(0, 1, (3, 7)), rng.integers(0, 2, (20, 7)).astype(float)
    rows = row_factors(x, columns)
    inner, target = columns @ columns.T, x @ columns.T
    slope = rows @ inner - target  # no descent is left: 0 where positive, not below 0 elsewhere
    assert (rows >= 0).all() and np.abs(slope[rows > 0]).max() < 1e-8 and slope[rows == 0].min() > -1e-8


def test_reduced_features(baskets):
    reduced = product.reduced_features(baskets.products_merged, FLAGS)
    names = ["p_reduced_feat_1", "p_reduced_feat_2", "p_reduced_feat_3"]
    norm = F.sqrt(sum(F.col(n) ** 2 for n in names))
    both = reduced.join(product.category_flags(baskets.products_merged, FLAGS), "product_id")
    any_flag = sum(F.col(n) for n in FLAGS) > 0
    bad = both.filter(
        (F.abs(norm - any_flag.cast("int")) > 1e-9) | (F.least(*names) < 0)
    )
    assert both.count() == baskets.products.count() and bad.count() == 0
    patterns = both.groupBy(*FLAGS).agg(F.countDistinct(F.struct(*names)).alias("n"))
    assert patterns.filter("n > 1").count() == 0
    again = product.reduced_features(baskets.products_merged.repartition(3), FLAGS)
    assert rows_of(again) == rows_of(reduced)


def test_any_number_of_flags(spark):
    names = [f"f{i}" for i in range(40)]
    rng = np.random.default_rng(4)
    flags = rng.integers(0, 2, (60, 40))
    flags[:3] = 0
    flags[10:20] = flags[10]
    rows = [(i, *map(int, f)) for i, f in enumerate(flags)] + [(60, *[None] * 40)]
    df = spark.createDataFrame(rows, "product_id long, " + ", ".join(f"{n} int" for n in names))
    found = {r[0]: r[1:] for r in pattern_factors(df, names, k=4, rounds=3).collect()}
    norms = {i: round(math.hypot(*v), 9) for i, v in found.items()}
    assert len(found) == 61 and len({found[i] for i in range(10, 20)}) == 1
    assert {norms[i] for i in (0, 1, 2, 60)} == {0.0} and {norms[i] for i in range(3, 60)} == {1.0}


@pytest.fixture(scope="module")
def parts(spark):
    """Rows whose label follows two of the features, so that there is something to learn."""
    def noise(salt):
        return F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(1000)) / 1000

    features = [noise(i).alias(name) for i, name in enumerate(MODEL_FEATURES)]
    rows = spark.range(4000).select((F.col("id") % 50).alias("user_id"), F.col("id").alias("product_id"), "id", *features)
    chance = 1 / (1 + F.exp(3 - 4 * F.col("u_p_order_rate") - 3 * F.col("hour_reorder_rate")))
    labelled = rows.withColumn(LABEL, (noise(99) < chance).cast("double")).drop("id")
    train, held_out = training.split(labelled)
    return train.cache(), held_out.cache()


@pytest.fixture(scope="module")
def boosted(parts):
    return models.fit_boosted_trees(parts[0], rounds=8, max_depth=4, step=0.2)


@pytest.fixture(scope="module")
def constant_loss(parts):
    share = parts[0].agg(F.avg(LABEL)).first()[0]
    return models.log_loss(parts[1].withColumn("p", F.lit(share))).first()[0]


def check(model, parts, constant_loss):
    scored = models.score(model, parts[1])
    assert scored.filter(~F.col("p").between(0, 1) | F.isnan("p")).count() == 0
    assert scored.count() == parts[1].count()
    assert models.log_loss(scored).first()[0] < constant_loss


def test_log_loss_and_accuracy_by_hand(spark):
    scored = spark.createDataFrame([(1.0, 0.8), (0.0, 0.4), (1.0, 0.0)], "reordered double, p double")
    expected = -(math.log(0.8) + math.log(0.6) + math.log(1e-15)) / 3
    assert models.log_loss(scored).first()[0] == pytest.approx(expected)
    assert models.accuracy(scored).first()[0] == pytest.approx(2 / 3)


def test_logistic_regression(parts, constant_loss):
    check(models.fit_logistic_regression(parts[0], max_iter=50), parts, constant_loss)


def test_boosted_trees(spark, parts, boosted, constant_loss):
    check(boosted, parts, constant_loss)
    importance = models.feature_importance(spark, boosted).collect()
    assert {r["feature"] for r in importance} == set(MODEL_FEATURES)
    values = [r["importance"] for r in importance]
    assert values == sorted(values, reverse=True) and sum(values) == pytest.approx(1)


def test_boosted_trees_stop_early(parts, constant_loss):
    model = models.fit_boosted_trees(*parts, rounds=25, max_depth=5, step=0.5, feature_share="0.4")
    assert 1 <= len(model.stages[-1].trees) < 25
    check(model, parts, constant_loss)


def test_small_steps_keep_growing_while_they_help(parts):
    model = models.fit_boosted_trees(*parts, rounds=30, max_depth=3, step=0.02, patience=20)
    assert len(model.stages[-1].trees) > 20
    single = models.fit_boosted_trees(parts[0], rounds=1, max_depth=3, step=0.02)
    losses = [models.log_loss(models.score(m, parts[1])).first()[0] for m in (model, single)]
    assert losses[0] < losses[1]


def test_best_round_waits_patiently():
    assert models.best_round([3, 2, 2.5, 1, 4, 5, 0], patience=3) == 7
    assert models.best_round([3, 2, 2.5, 1, 4, 5, 0], patience=2) == 4
    assert models.best_round([3, 2, 1], patience=5) == 3
    assert models.best_round([1, 2, 3, 0], patience=2) == 1


def test_folds_do_not_depend_on_placement(parts):
    grid = {"maxDepth": [2, 4], "minInstancesPerNode": [1, 3]}
    chosen = [models.fit_decision_tree(p, grid, n_candidates=3, folds=2)[1] for p in (parts[0], parts[0].repartition(3))]
    assert chosen[0] == chosen[1]


def test_decision_tree_search(parts, constant_loss):
    grid = {"maxDepth": [3, 5], "minInstancesPerNode": [2, 5]}
    model, chosen = models.fit_decision_tree(parts[0], grid, n_candidates=2, folds=2)
    assert chosen["maxDepth"] in grid["maxDepth"]
    assert model.stages[-1].getOrDefault("maxDepth") == chosen["maxDepth"]
    check(model, parts, constant_loss)


def test_calibrated_forest(spark, parts, constant_loss, tmp_path):
    model = models.fit_calibrated_forest(parts[0], trees=5, max_depth=4, folds=2)
    check(model, parts, constant_loss)
    assert models.feature_importance(spark, model).count() == len(MODEL_FEATURES)
    path = str(tmp_path / "forest")
    models.save_model(model, path)
    loaded = models.load_model(spark, path)
    assert rows_of(models.score(loaded, parts[1]), "user_id", "product_id", "p") == rows_of(
        models.score(model, parts[1]), "user_id", "product_id", "p"
    )


def test_perceptron(parts, constant_loss):
    check(models.fit_perceptron(parts[0], hidden=[8], max_iter=40), parts, constant_loss)


def test_saved_model_scores_alike(spark, parts, boosted, tmp_path):
    path = str(tmp_path / "model")
    models.save_model(boosted, path)
    loaded = models.load_model(spark, path)
    assert rows_of(models.score(loaded, parts[1]), "user_id", "product_id", "p") == rows_of(
        models.score(boosted, parts[1]), "user_id", "product_id", "p"
    )


def test_model_comparison(spark, parts, boosted):
    logistic = models.fit_logistic_regression(parts[0], max_iter=20)
    table = models.model_comparison(
        spark, [("boosted", {"rounds": 8}, boosted), ("logistic", {}, logistic)], *parts
    ).collect()
    losses = [r["log_loss_val"] for r in table]
    assert {r["model"] for r in table} == {"boosted", "logistic"} and losses == sorted(losses)


def test_permutation_importance_finds_the_planted_features(parts):
    train, held_out = parts
    model = models.fit_logistic_regression(train, max_iter=20)
    got = models.permutation_importance(model, held_out, repeats=3, block_rows=100).collect()
    by_name = {r["feature"]: r for r in got}
    assert [r["feature"] for r in got[:2]] == ["u_p_order_rate", "hour_reorder_rate"] and len(got) == 13
    assert all(abs(r["importance"]) < 0.02 for n, r in by_name.items() if n not in ("u_p_order_rate", "hour_reorder_rate"))
    assert got[0]["importance"] > 5 * got[0]["spread"] > 0
    again = models.permutation_importance(model, held_out.repartition(3), repeats=3, block_rows=100).collect()
    assert [(r["feature"], round(r["importance"], 9)) for r in again] == [(r["feature"], round(r["importance"], 9)) for r in got]


def test_exact_split_takes_the_share_of_every_label(spark):
    rows = [(i, i % 7, float(i % 5 == 0)) for i in range(1003)] + [(5000, 1, None), (5001, 1, None), (5002, 1, 2.0)]
    df = spark.createDataFrame(rows, "user_id long, product_id long, reordered double")
    marked = training.with_exact_split(df, share=0.2, seed=3)
    counts = {r[0]: (r[1], r[2]) for r in rows_of(marked.groupBy("reordered").agg(
        F.count("*").alias("n"), F.count_if(F.col("split") == "val").alias("v")), "reordered", "n", "v")}
    assert counts == {1.0: (201, 40), 0.0: (802, 160), 2.0: (1, 0), None: (2, 0)}
    assert rows_of(marked) == rows_of(training.with_exact_split(df.repartition(5), share=0.2, seed=3))
    for share, n in ((0.0, 0), (1.0, 1006)):
        assert training.with_exact_split(df, share, 3).filter("split = 'val'").count() == n
    assert training.with_exact_split(df.limit(0), 0.2, 3).count() == 0
    # Rows of one key stay together, at most the last key of a label is too much.
    twice = training.with_exact_split(df.unionByName(df), share=0.2, seed=3)
    assert twice.groupBy("user_id", "product_id").agg(F.countDistinct("split").alias("n")).filter("n > 1").count() == 0
