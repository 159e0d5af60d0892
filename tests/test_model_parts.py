"""Parts of the training set that are passed over many times."""

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import functions as F

from tests.helpers import rows_of
from trolley.operators import models, training
from trolley.schema import LABEL, MODEL_FEATURES


def test_stored_parts_are_those_of_the_split(baskets):
    for part, wanted in zip(baskets.parts, training.split(baskets.training_set)):
        assert rows_of(part) == rows_of(wanted)
        assert "md5" not in part._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def rows(spark):
    def noise(salt):
        return F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(1000)) / 1000

    features = [noise(i).alias(name) for i, name in enumerate(MODEL_FEATURES)]
    chance = (F.col(MODEL_FEATURES[0]) + F.col(MODEL_FEATURES[4])) / 2
    ids = spark.range(1500).select((F.col("id") % 50).alias("user_id"), F.col("id").alias("product_id"), "id", *features)
    return ids.withColumn(LABEL, (noise(99) < chance).cast("double")).drop("id")


def test_tree_search_is_a_cross_validation_that_keeps_no_rows(rows, monkeypatch):
    grid = {"maxDepth": [1, 4], "minInstancesPerNode": [2, 40]}
    estimator = DecisionTreeClassifier(seed=7, **models.COMMON)
    pipeline = models._pipeline(estimator)
    combos = [{"maxDepth": d, "minInstancesPerNode": n} for d in (1, 4) for n in (2, 40)]
    search = CrossValidator(
        estimator=pipeline, estimatorParamMaps=[{estimator.getParam(k): v for k, v in c.items()} for c in combos],
        evaluator=MulticlassClassificationEvaluator(metricName="accuracy", labelCol=LABEL), numFolds=3, foldCol="fold",
    )
    wanted = search.fit(models.with_fold(rows, 3, 7))
    for name in ("cache", "persist"):
        monkeypatch.setattr(type(rows), name, lambda *_: pytest.fail("rows are kept in memory"))
    model, chosen = models.fit_decision_tree(rows, grid, n_candidates=4, folds=3, seed=7)
    best = max(range(4), key=lambda i: wanted.avgMetrics[i])
    assert wanted.avgMetrics.count(wanted.avgMetrics[best]) > 1 or chosen == combos[best]
    assert combos.index(chosen) in [i for i in range(4) if wanted.avgMetrics[i] == pytest.approx(wanted.avgMetrics[best])]
    assert model.stages[-1].getMaxDepth() == chosen["maxDepth"]
    if chosen == combos[best]:
        assert model.stages[-1].toDebugString.split("\n")[1:] == wanted.bestModel.stages[-1].toDebugString.split("\n")[1:]
    with pytest.raises(ValueError):
        models.fit_decision_tree(rows.limit(1), grid, n_candidates=1, folds=3, seed=7)


def test_fits_on_many_rows_run_one_at_a_time(rows, monkeypatch):
    pools = []
    monkeypatch.setattr(models, "ThreadPool", lambda n, make=models.ThreadPool: pools.append(n) or make(n))
    grid = {"maxDepth": [1, 2]}
    few = models.fit_decision_tree(rows, grid, n_candidates=2, folds=2)[1]
    monkeypatch.setattr(models, "ROWS_AT_ONCE", 2 * rows.count() - 1)
    assert models.fit_decision_tree(rows, grid, n_candidates=2, folds=2)[1] == few and pools == [2, 1]
