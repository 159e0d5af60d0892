"""Reorder classifiers on Spark ML, and their evaluation.

Every ``fit_*`` returns a fitted ``PipelineModel`` (or ``CalibratedForest``)
whose ``transform`` adds ``probability``. Defaults are the settings of the
models this package stands in for; pass smaller ones for quick runs.
"""

import itertools
import json
import math
import random
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trolley.operators.boosting import BoostedTrees, fit_free_trees, fit_oblivious_trees
from trolley.operators.network import Network, fit_network
from trolley.operators.perceptron import fit_weights
from trolley.schema import LABEL, MODEL_FEATURES
from trolley.session import ensure_checkpoints
from trolley.sources.tables import path_exists

SEED = 42
COMMON = {"labelCol": LABEL, "featuresCol": "features", "probabilityCol": "probability"}

# Hidden layers of the perceptron.
HIDDEN_LAYERS = [256, 128, 64, 32]

# Random-search grid of the decision tree.
TREE_GRID = {"maxDepth": [5, 10, 15, 20], "minInstancesPerNode": [2, 3, 4, 5]}

# Rows that fits of a search running at the same time may hold in memory, some 160 bytes each.
ROWS_AT_ONCE = 1 << 25

# Boosted trees: the served model, and the variant that stops early.
SERVED_TREES = {"rounds": 2000, "max_depth": 13, "step": 0.02}
EARLY_STOPPING_TREES = {"rounds": 300, "max_depth": 15, "step": 0.02, "feature_share": "0.4"}

LOG_LOSS_EPS = 1e-15


def _assembler(output="features", columns=MODEL_FEATURES):
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid="keep")


def filled(df, columns=MODEL_FEATURES):
    """Zero for missing features; the models take no nulls."""
    return df.fillna(0.0, list(columns))


def _pipeline(estimator, scaled=False, columns=MODEL_FEATURES):
    if not scaled:
        return Pipeline(stages=[_assembler(columns=columns), estimator])
    scaler = StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True)
    return Pipeline(stages=[_assembler("raw_features", columns), scaler, estimator])


def fit_logistic_regression(train, max_iter=1000, penalty=1.0):
    """L2-penalised logistic regression on standardised features.

    ``penalty`` is the inverse of C on the summed loss; Spark averages the loss,
    hence the division by the row count.
    """
    train = filled(train)
    rows = max(train.count(), 1)
    estimator = LogisticRegression(
        maxIter=max_iter, regParam=penalty / rows, elasticNetParam=0.0, standardization=False, **COMMON
    )
    return _pipeline(estimator, scaled=True).fit(train)


def fit_decision_tree(train, grid=None, n_candidates=10, folds=5, parallelism=4, seed=SEED):
    """Decision tree chosen by cross-validation over a random part of the grid.

    Returns (model, chosen parameters).
    """
    grid = TREE_GRID if grid is None else grid
    estimator = DecisionTreeClassifier(seed=seed, **COMMON)
    pipeline = _pipeline(estimator)
    combos = [dict(zip(grid, values)) for values in itertools.product(*grid.values())]
    chosen = random.Random(seed).sample(combos, min(n_candidates, len(combos)))
    evaluator = MulticlassClassificationEvaluator(metricName="accuracy", labelCol=LABEL)
    folded = with_fold(filled(train), folds, seed)
    parts = [(folded.filter(F.col("fold") != k), folded.filter(F.col("fold") == k)) for k in range(folds)]
    for k, both in enumerate(parts):
        if any(part.isEmpty() for part in both):
            raise ValueError(f"fold {k} or all others are empty")

    def fit(combo, rows):
        return pipeline.fit(rows, {estimator.getParam(k): v for k, v in combo.items()})

    def held_out_accuracy(trial):
        combo, (rows, held_out) = trial
        return evaluator.evaluate(fit(combo, rows).transform(held_out))

    # A cross-validator would keep every fold's rows in memory next to those the fits keep.
    trials = [(combo, both) for both in parts for combo in chosen]
    at_once = max(1, min(parallelism, len(chosen), ROWS_AT_ONCE // max(folded.count(), 1)))
    with ThreadPool(at_once) as pool:
        found = pool.map(inheritable_thread_target(train.sparkSession)(held_out_accuracy), trials, chunksize=1)
    means = np.mean(np.reshape(found, (folds, len(chosen))), axis=0)
    best = max(range(len(chosen)), key=lambda i: means[i])
    return fit(chosen[best], folded), chosen[best]


class CalibratedForest:
    """Mean of sigmoid-calibrated forests, one per fold."""

    def __init__(self, members):
        self.members = members

    def transform(self, df):
        """Add ``probability`` as the mean over the members, and ``prediction``."""
        scored = df
        names = []
        for i, (forest, sigmoid) in enumerate(self.members):
            raw = forest.transform(scored).withColumn("score", vector_to_array("probability")[1])
            name = f"calibrated_{i}"
            slope, offset = sigmoid
            margin = F.lit(slope) * F.col("score") + F.lit(offset)
            scored = raw.withColumn(name, 1.0 / (1.0 + F.exp(-margin))).select(*scored.columns, name)
            names.append(name)
        mean = reduce(lambda a, b: a + b, [F.col(n) for n in names]) / F.lit(float(len(names)))
        return (
            scored.withColumn("p", mean)
            .withColumn("probability", array_to_vector(F.array(1.0 - F.col("p"), F.col("p"))))
            .withColumn("prediction", (F.col("p") >= 0.5).cast("double"))
            .drop("p", *names)
        )

    @property
    def feature_importances(self):
        vectors = [forest.stages[-1].featureImportances.toArray() for forest, _ in self.members]
        return sum(vectors) / len(vectors)

    def save(self, path):
        """Write the member forests and, next to them, the sigmoids."""
        for i, (forest, _) in enumerate(self.members):
            forest.write().overwrite().save(f"{path}/member-{i}")
        rows = [(i, float(s), float(o)) for i, (_, (s, o)) in enumerate(self.members)]
        schema = "member int, slope double, offset double"
        sigmoids = SparkSession.getActiveSession().createDataFrame(rows, schema)
        sigmoids.coalesce(1).write.mode("overwrite").parquet(f"{path}/sigmoids")

    @classmethod
    def load(cls, path):
        spark = SparkSession.getActiveSession()
        rows = spark.read.parquet(f"{path}/sigmoids").orderBy("member").collect()
        return cls([
            (PipelineModel.load(f"{path}/member-{row.member}"), (row.slope, row.offset))
            for row in rows
        ])


def with_fold(df, folds, seed=SEED):
    """Number of a row's fold, from the hash of its keys."""
    text = F.concat_ws("|", "user_id", "product_id", F.lit(f"fold{seed}"))
    return df.withColumn("fold", F.pmod(F.xxhash64(text), F.lit(folds)).cast("int"))


def fit_calibrated_forest(train, trees=25, max_depth=10, folds=5, seed=SEED):
    """Random forests with Platt scaling fitted on each held-out fold."""
    train = with_fold(filled(train), folds, seed)
    estimator = RandomForestClassifier(numTrees=trees, maxDepth=max_depth, seed=seed, **COMMON)
    members = []
    for fold in range(folds):
        forest = _pipeline(estimator).fit(train.filter(F.col("fold") != fold))
        held_out = forest.transform(train.filter(F.col("fold") == fold)).select(
            LABEL, F.array(vector_to_array("probability")[1]).alias("score_array")
        )
        scores = held_out.select(LABEL, array_to_vector("score_array").alias("score"))
        sigmoid = LogisticRegression(
            labelCol=LABEL, featuresCol="score", regParam=0.0, maxIter=100
        ).fit(scores)
        members.append((forest, (float(sigmoid.coefficients[0]), float(sigmoid.intercept))))
    return CalibratedForest(members)


def fit_perceptron(train, hidden=None, max_iter=100, block_size=128, seed=SEED):
    """Feed-forward network on standardised features.

    Spark's perceptron, which gives the first weights and takes the last ones by a
    fit of no steps; the steps between are made by ``perceptron.fit_weights``.
    """
    hidden = HIDDEN_LAYERS if hidden is None else hidden
    layers = [len(MODEL_FEATURES), *hidden, 2]
    train = filled(train)
    assembler, scaler = _pipeline(None, scaled=True).getStages()[:2]
    scaling = scaler.fit(assembler.transform(train))
    estimator = MultilayerPerceptronClassifier(layers=layers, maxIter=0, blockSize=block_size, seed=seed, **COMMON)
    one = train.sparkSession.createDataFrame([(0.0, Vectors.dense([0.0] * layers[0]))], [LABEL, "features"])
    first = estimator.fit(one).weights.toArray()
    deviations = scaling.std.toArray()
    factors = np.divide(1.0, deviations, out=np.zeros(len(deviations)), where=deviations != 0)
    weights = fit_weights(train, MODEL_FEATURES, first, layers, scaling.mean.toArray(), factors, max_iter, block_size)
    fitted = estimator.setInitialWeights(Vectors.dense(weights)).fit(one)
    return PipelineModel([assembler, scaling, fitted])


def best_round(losses, patience):
    """Number of the round (from 1) with the least loss before ``patience`` rounds without a gain."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def fit_boosted_trees(
    train, validation=None, rounds=2000, max_depth=13, step=0.02, feature_share="all",
    subsample=1.0, patience=20, seed=SEED,
):
    """Gradient-boosted trees; with ``validation``, only the rounds that help it.

    All rounds are grown, the held-out loss of each is taken, and the model is
    fitted again up to the best round before ``patience`` rounds without a gain.
    The defaults are ``SERVED_TREES``; ``EARLY_STOPPING_TREES`` go with a
    validation part. Each round is a pass over the data, and Spark grows trees
    level by level, so start with far smaller values.
    """
    estimator = GBTClassifier(
        maxIter=rounds, maxDepth=max_depth, stepSize=step, featureSubsetStrategy=feature_share,
        subsamplingRate=subsample, maxMemoryInMB=1024, seed=seed, labelCol=LABEL, featuresCol="features",
    )
    ensure_checkpoints(train.sparkSession)
    train = filled(train)
    model = _pipeline(estimator).fit(train)
    if validation is None:
        return model
    trees = model.stages[-1]
    losses = trees.evaluateEachIteration(model.stages[0].transform(filled(validation)))
    best = best_round(losses, patience)
    return model if best == rounds else _pipeline(estimator.setMaxIter(best)).fit(train)


def score(model, df):
    """Rows with ``p``, the model's probability of a reorder."""
    ready = filled(df, getattr(model, "columns", MODEL_FEATURES))
    return model.transform(ready).select(*df.columns, vector_to_array("probability")[1].alias("p"))


def _mean_loss(probability, label):
    p = F.greatest(F.lit(LOG_LOSS_EPS), F.least(F.col(probability), F.lit(1 - LOG_LOSS_EPS)))
    return F.avg(F.when(F.col(label) == 1, -F.ln(p)).otherwise(-F.ln(1 - p))).alias("log_loss")


def _share_right(probability, label):
    right = (F.col(probability) >= 0.5) == (F.col(label) == 1)
    return F.avg(right.cast("int")).alias("accuracy")


def log_loss(scored, probability="p", label=LABEL):
    """Mean negative log likelihood of 0/1 labels, probabilities clipped."""
    return scored.agg(_mean_loss(probability, label))


def accuracy(scored, probability="p", label=LABEL):
    """Share of rows on the right side of 0.5."""
    return scored.agg(_share_right(probability, label))


def evaluate(model, df):
    """One row: log loss and accuracy of a model on a labelled table."""
    return score(model, df).agg(_mean_loss("p", LABEL), _share_right("p", LABEL))


def feature_importance(spark, model, columns=MODEL_FEATURES):
    """Importance per feature, highest first (tree models only)."""
    if isinstance(model, (CalibratedForest, BoostedTrees)):
        weights = model.feature_importances
    else:
        weights = model.stages[-1].featureImportances.toArray()
    rows = [(name, float(w)) for name, w in zip(columns, weights)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )


def permutation_importance(model, df, columns=None, repeats=3, block_rows=1000, seed=SEED):
    """How much the log loss grows when a feature's values are exchanged between rows.

    Works for every model. Rows are dealt to hashed blocks of about ``block_rows``
    and take a feature from the next row of their block, in the order of a keyed
    hash; the last takes it from the first. All features are scored in one pass over
    copies of the rows, one a feature and repeat and one as it is. One row per
    feature: mean growth over the repeats, and their standard deviation.
    """
    columns = list(getattr(model, "columns", MODEL_FEATURES) if columns is None else columns)
    blocks = max(1, math.ceil(df.count() / block_rows))
    rows, donors = filled(df, columns), []
    for k in range(repeats):
        key = F.xxhash64("user_id", "product_id", F.lit(seed * 1009 + k))
        rows = rows.withColumns({f"_block{k}": F.pmod(F.xxhash64(key), F.lit(blocks)), f"_order{k}": key})
        block = W.partitionBy(f"_block{k}")
        order = block.orderBy(f"_order{k}", "user_id", "product_id")
        values = F.struct(*columns)
        first = F.first(values).over(order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
        rows = rows.withColumn(f"_donor{k}", F.coalesce(F.lead(values).over(order), first))
        donors.append((k, F.col(f"_donor{k}")))

    def copy(feature, k, donor):
        own = [donor[c].alias(c) if c == feature else F.col(c).alias(c) for c in columns]
        return F.struct(F.lit(feature).alias("_feature"), F.lit(k).alias("_repeat"), *own)

    copies = [copy(None, -1, None), *[copy(c, k, donor) for k, donor in donors for c in columns]]
    wide = rows.select("user_id", "product_id", LABEL, F.explode(F.array(*copies)).alias("_copy"))
    scored = score(model, wide.select("user_id", "product_id", LABEL, "_copy.*"))
    losses = scored.groupBy("_feature", "_repeat").agg(_mean_loss("p", LABEL).alias("loss"))
    # One row a feature and repeat.
    plain = F.max(F.when(F.col("_repeat") < 0, F.col("loss"))).over(W.partitionBy())
    growth = losses.select("_feature", "_repeat", (F.col("loss") - plain).alias("growth")).filter("_repeat >= 0")
    return growth.groupBy(F.col("_feature").alias("feature")).agg(
        F.avg("growth").alias("importance"), F.stddev_pop("growth").alias("spread")
    ).orderBy(F.desc("importance"), "feature")


# Small settings of all six families, for quick comparisons.
QUICK = {
    "logistic_regression": {"max_iter": 100},
    "decision_tree": {"grid": {"maxDepth": [5], "minInstancesPerNode": [2, 5]}, "n_candidates": 2, "folds": 2},
    "calibrated_forest": {"trees": 10, "max_depth": 5, "folds": 2},
    "network": {"hidden": [32, 16], "epochs": 2, "steps": 8, "rate": 0.01},
    "free_trees": {"rounds": 5, "depth": 4, "step": 0.3, "n_bins": 32},
    "oblivious_trees": {"rounds": 8, "depth": 4, "step": 0.3, "n_bins": 32},
}


def fit_families(train, validation, settings=None):
    """All six model families: (name, parameters, model) as ``model_comparison`` takes them.

    ``settings`` has the parameters of the families wanted; by default each has its
    own full-size ones. Networks and free trees stop by the held-out loss.
    """
    fits = {
        "logistic_regression": lambda **p: fit_logistic_regression(train, **p),
        "decision_tree": lambda **p: fit_decision_tree(train, **p)[0],
        "calibrated_forest": lambda **p: fit_calibrated_forest(train, **p),
        "network": lambda **p: fit_network(train, validation, **p),
        "free_trees": lambda **p: fit_free_trees(train, validation, **p),
        "oblivious_trees": lambda **p: fit_oblivious_trees(train, **p),
    }
    settings = {name: {} for name in fits} if settings is None else settings
    return [(name, parameters, fits[name](**parameters)) for name, parameters in settings.items()]


def model_comparison(spark, entries, train, validation):
    """One row per (name, parameters, model): its log loss and accuracies."""
    parts = []
    for name, parameters, model in entries:
        on_train, on_validation = evaluate(model, train).first(), evaluate(model, validation).first()
        parts.append((
            name, json.dumps(parameters, sort_keys=True), on_validation["log_loss"],
            on_train["accuracy"], on_validation["accuracy"],
        ))
    return spark.createDataFrame(
        parts,
        "model string, parameters string, log_loss_val double, "
        "train_accuracy double, val_accuracy double",
    ).orderBy("log_loss_val", "model")


def save_model(model, path):
    """Write a fitted model, replacing what is there."""
    if isinstance(model, (CalibratedForest, BoostedTrees, Network)):
        model.save(path)
    else:
        model.write().overwrite().save(path)


def load_model(spark, path):
    """Read a model written by ``save_model``."""
    for part, kind in (("sigmoids", CalibratedForest), ("boosting", BoostedTrees), ("network", Network)):
        if path_exists(spark, f"{path}/{part}"):
            return kind.load(path)
    return PipelineModel.load(path)
