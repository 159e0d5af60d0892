"""The perceptron's own passes against Spark's perceptron."""

import numpy as np
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.sql import functions as F

from trolley.operators import models, perceptron
from trolley.schema import LABEL, MODEL_FEATURES


def test_weights_are_those_of_spark_and_no_row_is_kept(spark):
    noise = [(F.pmod(F.xxhash64("id", F.lit(i)), F.lit(997)) / 100.0).alias(c) for i, c in enumerate(MODEL_FEATURES)]
    rows = spark.range(1000, numPartitions=3).select("id", *noise).withColumn(
        LABEL, (F.col(MODEL_FEATURES[0]) + F.col(MODEL_FEATURES[3]) > 9).cast("double")
    )
    plain = MultilayerPerceptronClassifier(
        layers=[len(MODEL_FEATURES), 6, 4, 2], maxIter=12, blockSize=64, seed=7, **models.COMMON
    )
    wanted = models._pipeline(plain, scaled=True).fit(rows)
    kept = spark.sparkContext._jsc.sc().getRDDStorageInfo()
    persisted, persist = [], plain._fit
    MultilayerPerceptronClassifier._fit, whole = (
        lambda self, df: persisted.append(df.count()) or persist.__func__(self, df), MultilayerPerceptronClassifier._fit
    )
    try:
        found = models.fit_perceptron(rows, hidden=[6, 4], max_iter=12, block_size=64, seed=7)
    finally:
        MultilayerPerceptronClassifier._fit = whole
    assert persisted == [1, 1] and len(kept) == 0  # Spark's own fit, which holds all rows, sees none of them
    assert np.abs(found.stages[-1].weights.toArray() - wanted.stages[-1].weights.toArray()).max() < 1e-6


def test_gradient_is_the_slope_of_the_loss():
    rng = np.random.default_rng(3)
    sizes, values, label = [3, 4, 2], rng.normal(size=(20, 3)), rng.integers(0, 2, 20).astype(float)
    at = rng.normal(size=26)
    sums = lambda x: perceptron.loss_and_gradient(perceptron.shaped(x, sizes), values, label)
    for k in range(len(at)):
        step = np.eye(len(at))[k] * 1e-6
        assert abs((sums(at + step)[-1] - sums(at - step)[-1]) / 2e-6 - sums(at)[k]) < 1e-5


def test_a_bracket_gives_the_least_point_from_either_end():
    ends = [(t, (t - 0.3) ** 2, 2 * (t - 0.3)) for t in (0.0, 1.0)]
    assert abs(perceptron._between(*ends) - 0.3) < 1e-12 and abs(perceptron._between(*ends[::-1]) - 0.3) < 1e-12
