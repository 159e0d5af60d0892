"""Boosted trees and the minibatch network against plain numpy twins."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.helpers import rows_of
from trolley.operators import boosting, models, network, training
from trolley.operators.boosting import UNIT
from trolley.schema import LABEL

COLUMNS = ["u_p_order_rate", "u_p_reorder_rate", "hour_reorder_rate", "max_streak"]


@pytest.fixture(scope="module")
def parts(spark):
    """1200 rows whose label follows two of the features, with ties, a null and a constant column."""
    rng = np.random.default_rng(7)
    values = rng.uniform(0, 1, (1200, 3)).round(2)
    chance = 1 / (1 + np.exp(3 - 4 * values[:, 0] - 3 * values[:, 2]))
    labels = (rng.uniform(0, 1, 1200) < chance).astype(float)
    rows = [
        (i % 50, i, *[None if (i, k) == (5, 1) else float(v) for k, v in enumerate(row)], 3.0, float(y))
        for i, (row, y) in enumerate(zip(values, labels))
    ]
    table = spark.createDataFrame(rows, ["user_id", "product_id", *COLUMNS, LABEL])
    train, held = (df.cache() for df in training.split(table))
    return train, held


def arrays(df):
    rows = df.fillna(0.0, COLUMNS).select(*COLUMNS, LABEL, "user_id", "product_id").collect()
    values = np.array([[r[c] for c in COLUMNS] for r in rows])
    return values, np.array([r[LABEL] for r in rows])


class Twin:
    """The same trees, grown on matrices by trying every split of every node."""

    def __init__(self, model, values, label, l2, step, min_weight, n_bins):
        self.bins = np.stack([(values[:, [k]] > np.array(e)).sum(1) for k, e in enumerate(model.borders)], axis=1)
        self.label, self.l2, self.step, self.min_weight, self.n_bins = label, l2 * UNIT, step, min_weight * UNIT, n_bins
        share = label.mean()
        self.base = math.log(share / (1 - share))
        self.margin = np.full(len(label), self.base)

    def sums(self):
        p = 1 / (1 + np.exp(-self.margin))
        return np.rint((p - self.label) * UNIT).astype(int), np.rint(p * (1 - p) * UNIT).astype(int)

    def score(self, g, h):
        return float(g) * g / (h + self.l2) / UNIT

    def gain(self, rows, g, h, f, b):
        low = rows & (self.bins[:, f] <= b)
        high = rows & ~low
        if min(h[low].sum(), h[high].sum()) < self.min_weight:
            return None
        parts = [self.score(g[x].sum(), h[x].sum()) for x in (low, high, rows)]
        return int((parts[0] + parts[1] - parts[2]) * (1 << 20))

    def best(self, nodes, g, h, chosen):
        def total(f, b):
            gains = [self.gain(rows, g, h, f, b) for rows in nodes]
            return None if None in gains else sum(gains)

        found = [(x, -f, -b) for f in chosen for b in range(self.n_bins) if (x := total(f, b)) is not None]
        return max(found, default=(0, 0, 0))

    def value(self, rows, g, h):
        return -self.step * float(g[rows].sum()) / (h[rows].sum() + self.l2) if rows.any() else 0.0

    def oblivious(self, depth):
        g, h = self.sums()
        nodes, splits = [np.ones(len(self.label), bool)], []
        for _ in range(depth):
            x, f, b = self.best([n for n in nodes if n.any()], g, h, range(len(COLUMNS)))
            if x <= 0:
                break
            splits.append((-f, -b))
            above = self.bins[:, -f] > -b
            nodes = [n & ~above for n in nodes] + [n & above for n in nodes]
        values = [self.value(n, g, h) for n in nodes]
        for n, v in zip(nodes, values):
            self.margin[n] += v
        return splits, values

    def free(self, depth, chosen):
        g, h = self.sums()
        nodes, level = [(np.ones(len(self.label), bool), None)], [0]
        for _ in range(depth):
            following = []
            for k in level:
                rows = nodes[k][0]
                x, f, b = self.best([rows], g, h, chosen)
                if x > 0:
                    nodes[k] = (rows, (-f, -b))
                    above = self.bins[:, -f] > -b
                    following += [len(nodes), len(nodes) + 1]
                    nodes += [(rows & ~above, None), (rows & above, None)]
            level = following
        for rows, split in nodes:
            if split is None:
                self.margin[rows] += self.value(rows, g, h)
        return [split for _, split in nodes]

    def loss(self):
        return np.logaddexp(0, np.where(self.label == 1, -self.margin, self.margin)).mean()


def test_oblivious_trees_equal_their_twin(spark, parts, monkeypatch):
    monkeypatch.setattr(boosting, "STORE_EVERY", 2)  # margins are stored on the way
    train, held = parts
    model = boosting.fit_oblivious_trees(train, held, rounds=4, depth=3, step=0.3, l2=3.0, n_bins=12, columns=COLUMNS, patience=9)
    twin = Twin(model, *arrays(train), 3.0, 0.3, 0.0, 12)
    losses = [twin.loss()]
    for tree in model.trees:
        splits, values = twin.oblivious(3)
        assert list(zip(tree.feature, tree.bin)) == splits
        assert np.allclose(tree.values, values, rtol=0, atol=1e-12)
        losses.append(twin.loss())
    assert len(model.trees) == 4 and np.allclose([t for t, _ in model.history], losses, atol=1e-6)
    assert all(b < a for a, b in zip(losses, losses[1:]))
    values, label = arrays(held)
    margin = model.margins(values)
    assert model.history[-1][1] == pytest.approx(np.logaddexp(0, np.where(label == 1, -margin, margin)).mean(), abs=1e-6)


def test_free_trees_equal_their_twin(parts, monkeypatch):
    monkeypatch.setattr(boosting, "CELLS", 60)  # a few nodes a pass
    train, _ = parts
    model = boosting.fit_free_trees(train, rounds=2, depth=4, step=0.3, feature_share=0.5, n_bins=10, seed=3, columns=COLUMNS)
    twin = Twin(model, *arrays(train), 1.0, 0.3, 1.0, 10)
    for k, tree in enumerate(model.trees):
        chosen = sorted(random.Random(3 * 1_000_003 + k).sample(range(4), 2))
        want = twin.free(4, chosen)
        assert [(f, b) if f >= 0 else None for f, b in zip(tree.feature, tree.bin)] == want
        assert {f for f in tree.feature if f >= 0} <= set(chosen)
    assert len(model.trees) == 2
    assert np.allclose(model.margins(arrays(train)[0]), twin.margin, atol=1e-9)


def test_trees_do_not_depend_on_partitions(parts):
    train, held = parts
    fit = lambda df: boosting.fit_oblivious_trees(df, held, rounds=2, depth=2, step=0.3, n_bins=12, columns=COLUMNS)
    a, b = fit(train), fit(train.repartition(7, "product_id"))
    assert b.borders == a.borders and [t.values for t in a.trees] == [t.values for t in b.trees]
    assert a.history == b.history


def test_growing_stops_with_patience(parts):
    train, held = parts
    # Labels of the held-out part are turned round, so every tree makes its loss worse.
    worse = held.withColumn(LABEL, 1 - F.col(LABEL))
    model = boosting.fit_free_trees(train, worse, rounds=30, depth=3, step=0.3, patience=2, n_bins=8, columns=COLUMNS)
    assert len(model.trees) == 0 and len(model.history) == 3  # rounds seen: the best (0) and patience
    assert len({round(p, 9) for (p,) in rows_of(models.score(model, held), "p")}) == 1


def test_native_and_python_scores_agree_after_saving(spark, parts, tmp_path):
    train, held = parts
    constant = models.log_loss(held.withColumn("p", F.lit(train.agg(F.avg(LABEL)).first()[0]))).first()[0]
    fits = {
        "oblivious": lambda: boosting.fit_oblivious_trees(train, rounds=3, depth=3, step=0.5, n_bins=12, columns=COLUMNS),
        "free": lambda: boosting.fit_free_trees(train, rounds=3, depth=3, step=0.5, n_bins=12, columns=COLUMNS),
        "network": lambda: network.fit_network(train, held, hidden=(8,), epochs=4, steps=2, rate=0.1, columns=COLUMNS),
    }
    for name, fit in fits.items():
        model = fit()
        models.save_model(model, f"{tmp_path}/{name}")
        again = models.load_model(spark, f"{tmp_path}/{name}")
        before, after = models.score(model, held), models.score(again, held)
        assert rows_of(before) == rows_of(after)
        assert models.log_loss(before).first()[0] < constant
        if name != "network":
            p = [r["p"] for r in before.orderBy("product_id").collect()]
            values = np.array([[r[c] for c in COLUMNS] for r in held.fillna(0.0, COLUMNS).orderBy("product_id").collect()])
            assert np.allclose(p, 1 / (1 + np.exp(-model.margins(values))), atol=1e-9)
            shares = model.feature_importances
            assert shares.sum() == pytest.approx(1) and shares[[0, 2]].sum() > shares[[1, 3]].sum()
        if name == "oblivious":
            native = before
    plan = native._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


# --- network ----------------------------------------------------------------

def test_gradient_equals_differences():
    rng = np.random.default_rng(1)
    sizes = [4, 5, 3, 1]
    vector = network.flat(network.first_weights(sizes, 2))
    values, label, marks = rng.normal(size=(30, 4)), rng.integers(0, 2, 30), rng.integers(0, 2**63, 30).astype(np.uint64)

    def loss(v):
        weights, out = network.shaped(v, sizes), values
        for layer, (w, b) in enumerate(weights[:-1]):
            out = np.maximum(out @ w + b, 0) * network.dropout_mask(marks, 1, layer, w.shape[1], 0.3)
        margin = (out @ weights[-1][0] + weights[-1][1])[:, 0]
        return np.logaddexp(0, np.where(label == 1, -margin, margin)).sum()

    got = network.gradients(network.shaped(vector, sizes), values, label, marks, 1, 0.3)
    for k in range(0, len(vector), 3):
        step = np.zeros(len(vector))
        step[k] = 1e-6
        assert got[k] == pytest.approx((loss(vector + step) - loss(vector - step)) / 2e-6, abs=1e-5)
    share = network.dropout_mask(marks.repeat(200), 0, 0, 40, 0.3)
    assert (network.dropout_mask(np.arange(5000, dtype=np.uint64), 0, 1, 40, 0.3) == 0).mean() == pytest.approx(0.3, abs=0.01)
    assert set(share.ravel().round(6)) <= {0.0, round(1 / 0.7, 6)}


def test_network_equals_numpy_and_repeats(parts):
    train, held = parts
    options = dict(hidden=(6, 4), dropout=0.25, rate=0.02, epochs=3, steps=3, columns=COLUMNS)
    one = train.coalesce(1)
    model = network.fit_network(one, held, **options)
    assert (network.fit_network(one, held, **options).vector == model.vector).all()

    filled = one.fillna(0.0, COLUMNS)
    rows = training.fit_scaling(filled, COLUMNS).transform(filled).select(
        *COLUMNS, LABEL, F.xxhash64("user_id", "product_id").alias("mark")
    ).collect()
    values, label = np.array([[r[c] for c in COLUMNS] for r in rows]), np.array([r[LABEL] for r in rows])
    marks = np.array([r["mark"] for r in rows])
    sizes = [4, 6, 4, 1]
    vector = network.flat(network.first_weights(sizes, 42))
    state, seen = (0, np.zeros(len(vector)), np.zeros(len(vector))), []
    for epoch in range(3):
        for step in range(3):
            own = marks % 3 == step
            g = network.gradients(network.shaped(vector, sizes), values[own], label[own], marks[own].view(np.uint64), epoch, 0.25)
            vector, state = network.adam(vector, g / own.sum(), state, 0.02)
        seen.append(vector)
    best = model.history.index(min(model.history))
    assert len(model.history) == 3 and np.allclose(model.vector, seen[best], atol=1e-9)


def test_network_stops_and_keeps_the_best(parts):
    train, held = parts
    worse = held.withColumn(LABEL, 1 - F.col(LABEL))
    model = network.fit_network(train, worse, hidden=(4,), dropout=0.0, rate=0.1, epochs=6, steps=1, patience=2, columns=COLUMNS)
    best = model.history.index(min(model.history))
    assert len(model.history) == min(6, best + 3)
