"""Boosted trees of second order, grown from histograms.

Features are cut into at most ``n_bins`` quantile bins once. Growing a level of a
tree is one pass over the rows: every task adds up gradients and hessians by
(node, feature, bin), Spark sums them and picks the splits, and only the chosen
ones come to the driver. Another pass sums the leaves. A row's margin is stored
with it every few trees; the trees since then are applied on the way.

Two shapes. *Oblivious* trees have one split a level that all its nodes share, so a
tree is a look-up by as many bits as it has levels. *Free* trees split each node
for itself and may see a share of the features each. Both stop while growing when
the held-out loss has not improved for ``patience`` rounds, and keep the best round;
no second fit is needed.

Gradients, hessians and losses are added as whole numbers of 2^-24, so sums, and
with them the trees, do not depend on how rows are dealt to tasks. This holds up
to 5 * 10^11 rows. Missing features count as 0. Ties between splits go to the
first feature, then the lowest bin.

Up to ``FEW_ROWS`` rows meet in one task, which grows the same trees by itself: a job
a level would take far longer than the level.
"""

import math
import pickle
import random
import zlib
from array import array
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from trolley.schema import LABEL, MODEL_FEATURES
from trolley.session import work_folder

UNIT = 1 << 24
STORE_EVERY = 16  # trees applied on the way before margins are stored again
CELLS = 1 << 22  # histogram cells a task holds at once
BLOCK_ROWS = 10_000  # rows stored as one, at most
FEW_ROWS = 1 << 19  # some 100 bytes each in the task that holds them
NODES_AT_ONCE = 1 << 10  # whose splits are compared at once, where rows are few; they stay in a core's cache
TREES_TOLD = 64  # trees a row has that comes from that task
NATIVE_VALUES = 1 << 12  # leaves that oblivious trees may have as literals of a plan


@dataclass
class Tree:
    """Splits by (feature number, bin): one a level if oblivious, else one a node (-1 in leaves)."""

    feature: list
    bin: list
    left: list = None
    right: list = None
    values: list = field(default_factory=list)

    def leaves(self, bins):
        """The leaf (or, while growing, the node) of each row of a matrix of bins."""
        at = np.zeros(len(bins), np.int64)
        if self.left is None:
            for level, (f, b) in enumerate(zip(self.feature, self.bin)):
                at |= (bins[:, f] > b).astype(np.int64) << level
            return at
        feature, limit, left, right = (np.array(x, np.int64) for x in (self.feature, self.bin, self.left, self.right))
        rows = np.arange(len(bins))
        while True:
            f = feature[at]
            inner = f >= 0
            if not inner.any():
                return at
            right_side = bins[rows, np.maximum(f, 0)] > limit[at]
            at = np.where(inner, np.where(right_side, right[at], left[at]), at)


def _matrix(column, n_features):
    """The bins of a binary column, all values ``n_features`` bytes long, without a copy."""
    if not len(column):
        return np.zeros((0, n_features), np.uint8)
    _, offsets, data = column.buffers()
    first = np.frombuffer(offsets, np.int32)[column.offset]
    return np.frombuffer(data, np.uint8)[first : first + len(column) * n_features].reshape(-1, n_features)


def _packed(run):
    """Each batch of ``run`` as one row: a pass hands over blocks, not single rows."""
    def pack(batches):
        for batch in run(batches):
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, batch.schema) as stream:
                    stream.write_batch(batch.slice(start, BLOCK_ROWS))
                yield pa.RecordBatch.from_pydict({"block": [sink.getvalue().to_pybytes()]})

    return pack


def _blocks(batches):
    """The batches that were packed."""
    for batch in batches:
        for block in batch.column(0):
            yield from pa.ipc.open_stream(block.as_buffer())


def _margins(batch, trees, n_features):
    bins = _matrix(batch.column(0), n_features)
    margin = batch.column(3).to_numpy().copy()
    for tree in trees:
        margin += np.array(tree.values)[tree.leaves(bins)]
    return bins, margin


def _sums(trees, growing, chosen, nodes, n_bins, n_features, with_loss):
    """Per cell (node, feature, bin): sums over the node's rows up to the bin, and over all its rows.

    Slots -1 and -2 hold the summed losses of the train and the held-out part.
    """
    place = np.full(max(nodes, default=-1) + 2, -1)
    place[nodes] = np.arange(len(nodes))

    def run(batches):
        cells = len(nodes) * len(chosen) * n_bins
        total = np.zeros((3, cells), np.int64)
        losses = np.zeros((2, 2), np.int64)
        for batch in _blocks(batches):
            bins, margin = _margins(batch, trees, n_features)
            label, held = batch.column(1).to_numpy(), batch.column(2).to_numpy(zero_copy_only=False)
            chance = 1 / (1 + np.exp(-margin))
            if with_loss:
                loss = np.rint(np.logaddexp(0, np.where(label == 1, -margin, margin)) * UNIT).astype(np.int64)
                for k, rows in enumerate((~held, held)):
                    losses[k] += loss[rows].sum(), rows.sum()
            slot = place[np.minimum(growing.leaves(bins), len(place) - 1)]
            own = np.flatnonzero(~held & (slot >= 0))
            gradient, hessian = (np.rint(x[own] * UNIT) for x in (chance - label, chance * (1 - chance)))
            for c, f in enumerate(chosen):
                at = (slot[own] * len(chosen) + c) * n_bins + (bins[own, f] if n_bins > 1 else 0)
                for k, weights in enumerate((gradient, hessian, None)):
                    total[k] += np.bincount(at, weights, cells).astype(np.int64)
        low = np.cumsum(total.reshape(3, -1, n_bins), axis=2)
        every = np.repeat(low[:, :, -1:], n_bins, axis=2)
        g, h, n, all_g, all_h = (x.ravel() for x in (*low, every[0], every[1]))
        full = np.flatnonzero(every[2].ravel())
        columns = [x[full] for x in (np.arange(cells), g, h, n, all_g, all_h)]
        if with_loss:
            extra = [np.array([-1, -2]), losses[:, 0], *np.zeros((4, 2), np.int64)]
            extra[3] = losses[:, 1]
            columns = [np.concatenate(both) for both in zip(columns, extra)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=_SUMS)

    return run


_SUMS = ["slot", "g", "h", "n", "all_g", "all_h"]


def _stored(trees, n_features):
    def run(batches):
        for batch in _blocks(batches):
            _, margin = _margins(batch, trees, n_features)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(margin)], names=["bins", "label", "held", "margin"])

    return run


def quantile_borders(train, columns, n_bins):
    """Per column, the ascending values that part it into at most ``n_bins`` bins."""
    shares = [i / n_bins for i in range(1, n_bins)]
    row = train.agg(*[F.percentile_approx(c, shares, 100 * n_bins).alias(c) for c in columns]).first()
    return [sorted(set(row[c] or [])) for c in columns]


def bin_numbers(values, edges):
    """How many borders lie below each value."""
    return np.searchsorted(np.array(edges, float), values, "left")


def _binned(borders):
    def run(batches):
        for batch in batches:
            found = np.empty((batch.num_rows, len(borders)), np.uint8)
            for k, edges in enumerate(borders):
                found[:, k] = bin_numbers(batch.column(k).to_numpy(), edges)
            ends = np.arange(batch.num_rows + 1, dtype=np.int32) * len(borders)
            rows = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(ends), pa.py_buffer(found)])
            yield pa.RecordBatch.from_arrays([rows, *batch.columns[len(borders) :]], names=["bins", "label", "held", "margin"])

    return run


_BLOCKS = "block binary"  # of bins, label, held, margin


class Grower:
    """Rows with their margins, and the trees grown so far."""

    def __init__(self, train, validation, columns, n_bins, l2, step, min_weight=0.0):
        if not 2 <= n_bins <= 256:
            raise ValueError("n_bins must lie between 2 and 256")
        self.spark, self.columns, self.n_bins = train.sparkSession, list(columns), n_bins
        self.l2, self.step, self.min_weight = l2, step, min_weight
        parts = [self._plain(train, False), *([] if validation is None else [self._plain(validation, True)])]
        positive, n = parts[0].agg(F.sum("label"), F.count("*")).first()
        share = min(max((positive or 0.0) / max(n, 1), 1e-6), 1 - 1e-6)
        self.base = math.log(share / (1 - share))
        self.borders = quantile_borders(parts[0], self.columns, n_bins)
        rows = reduce(lambda a, b: a.unionByName(b), parts).withColumn("margin", F.lit(self.base))
        self.few = n + (0 if validation is None else parts[1].count()) <= FEW_ROWS and l2 > 0
        self.rows = self._write(rows.mapInArrow(_packed(_binned(self.borders)), _BLOCKS))
        self.trees, self.unstored, self.gains = [], [], [0.0] * len(self.columns)

    def _plain(self, df, held):
        values = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in self.columns]
        return df.select(*values, F.col(LABEL).cast("double").alias("label"), F.lit(held).alias("held"))

    def _write(self, rows):
        path = work_folder(self.spark, "boosting")
        rows.write.parquet(path)
        return self.spark.read.schema(_BLOCKS).parquet(path)

    def _summed(self, growing, chosen, nodes, n_bins, with_loss=False):
        run = _sums(self.unstored, growing, chosen, nodes, n_bins, len(self.columns), with_loss)
        passed = self.rows.mapInArrow(run, ", ".join(f"{c} long" for c in _SUMS))
        return passed.groupBy("slot").agg(*[F.sum(c).alias(c) for c in _SUMS[1:]])

    def _cells(self, summed, n_chosen):
        """The cells with the gain of splitting their node after their bin, in units of 2^-20."""
        inside = F.pmod("slot", F.lit(n_chosen * self.n_bins))

        def score(g, h):
            return g.cast("double") * g / (h + F.lit(self.l2 * UNIT)) / F.lit(float(UNIT))

        g, h, all_g, all_h = (F.col(c) for c in ("g", "h", "all_g", "all_h"))
        heavy = F.least(h, all_h - h) >= F.lit(self.min_weight * UNIT)
        gain = score(g, h) + score(all_g - g, all_h - h) - score(all_g, all_h)
        return summed.select(
            F.when(F.col("slot") < 0, F.col("slot")).otherwise(F.floor(F.col("slot") / (n_chosen * self.n_bins))).alias("node"),
            F.when(F.col("slot") < 0, F.col("slot")).otherwise(F.floor(inside / self.n_bins)).cast("int").alias("feature"),
            F.when(F.col("slot") < 0, 0).otherwise(inside % self.n_bins).cast("int").alias("bin"),
            F.when((F.col("slot") >= 0) & heavy, (gain * (1 << 20)).cast("long")).alias("gain"), "g", "n",
        )

    def _losses(self, rows, key):
        found = {r[key]: r["g"] / UNIT / r["n"] for r in rows if r[key] < 0 and r["n"]}
        return found.get(-1), found.get(-2)

    def shared_split(self, growing, chosen, with_loss):
        """The split (feature number, bin, gain) that serves all nodes best, None without a gain; and the losses."""
        n_nodes, per_pass = 1 << len(growing.feature), max(1, CELLS // (len(chosen) * self.n_bins))
        gains, losses = {}, (None, None)
        for start in range(0, n_nodes, per_pass):
            nodes = list(range(start, min(start + per_pass, n_nodes)))
            cells = self._cells(self._summed(growing, chosen, nodes, self.n_bins, with_loss and not start), len(chosen))
            rows = cells.groupBy("feature", "bin").agg(*[F.sum(c).alias(c) for c in ("gain", "g", "n")]).collect()
            losses = losses if start else self._losses(rows, "feature")
            for r in rows:
                if r["feature"] >= 0:
                    at = (r["feature"], r["bin"])
                    gains[at] = gains.get(at, 0) + (r["gain"] or 0)
        best = max(gains, key=lambda at: (gains[at], -at[0], -at[1]), default=None)
        if best is None or gains[best] <= 0:
            return None, losses
        return (chosen[best[0]], best[1], gains[best]), losses

    def own_splits(self, growing, chosen, nodes, with_loss):
        """node -> (feature number, bin, gain) for each node that gains by a split; and the losses."""
        per_pass, found, losses = max(1, CELLS // (len(chosen) * self.n_bins)), {}, (None, None)
        for start in range(0, len(nodes), per_pass):
            part = nodes[start : start + per_pass]
            cells = self._cells(self._summed(growing, chosen, part, self.n_bins, with_loss and not start), len(chosen))
            order = F.struct(F.coalesce("gain", F.lit(0)), -F.col("feature"), -F.col("bin"))
            top = F.max_by(F.struct("feature", "bin", "gain"), order).alias("s")
            rows = cells.groupBy("node").agg(top, F.sum("g").alias("g"), F.sum("n").alias("n")).collect()
            losses = losses if start else self._losses(rows, "node")
            for r in rows:
                if r["node"] >= 0 and (r["s"]["gain"] or 0) > 0:
                    found[part[r["node"]]] = (chosen[r["s"]["feature"]], r["s"]["bin"], r["s"]["gain"])
        return found, losses

    def finish(self, tree, leaves):
        """Give the leaves their values and add the tree to the margins."""
        sums = {r["slot"]: (r["g"], r["h"]) for r in self._summed(tree, [0], leaves, 1).collect()}
        tree.values = array("d", bytes(8 * (max(leaves) + 1)))
        for k, leaf in enumerate(leaves):
            g, h = sums.get(k, (0, 0))
            tree.values[leaf] = -self.step * g / (h + self.l2 * UNIT) if h + self.l2 else 0.0
        self.trees.append(tree)
        self.unstored.append(tree)
        if len(self.unstored) == STORE_EVERY:
            passed = self.rows.mapInArrow(_packed(_stored(self.unstored, len(self.columns))), _BLOCKS)
            self.rows = self._write(passed)
            self.unstored = []

    def losses(self):
        """Mean losses of both parts with all trees."""
        rows = self._summed(Tree([], []), [0], [], 1, True).collect()
        return self._losses(rows, "slot")


class FewRows:
    """What ``Grower`` does, in the memory of one task."""

    def __init__(self, blocks, borders, base, l2, step, min_weight):
        self.columns, self.borders, self.base = range(len(borders)), borders, base
        self.l2, self.step, self.min_weight, self.trees = l2, step, min_weight, []
        parts = [
            (_matrix(b.column(0), len(borders)), b.column(1).to_numpy(), b.column(2).to_numpy(zero_copy_only=False), b.column(3).to_numpy())
            for b in blocks
        ]
        bins, label, held, margin = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(held, kind="stable")  # the train part first
        self.n_own, self.bins = int((~held).sum()), np.ascontiguousarray(bins[order].T)
        self.label, self.margin, self.tree, self.derived = label[order], margin[order], None, False

    def _derive(self):
        """Gradients, hessians and losses at the present margins."""
        if not self.derived:
            own, label, margin = slice(self.n_own), self.label, self.margin
            chance = 1 / (1 + np.exp(-margin[own]))
            self.g, self.h = (np.rint(x * UNIT) for x in (chance - label[own], chance * (1 - chance)))
            loss = np.rint(np.logaddexp(0, np.where(label == 1, -margin, margin)) * UNIT).astype(np.int64)
            parts = (loss[own], loss[self.n_own :])
            self.found = tuple(int(x.sum()) / UNIT / len(x) if len(x) else None for x in parts)
            self.derived = True

    def _nodes(self, tree):
        """The node of every row; what is known of a tree's upper levels is kept."""
        if tree is not self.tree:
            self.tree, self.at, self.levels = tree, np.zeros(len(self.label), np.int64), 0
        if tree.left is None:
            for level in range(self.levels, len(tree.feature)):
                self.at |= (self.bins[tree.feature[level]] > tree.bin[level]).astype(np.int64) << level
            self.levels = len(tree.feature)
            return self.at
        feature, limit, left, right = (np.array(x, np.int64) for x in (tree.feature, tree.bin, tree.left, tree.right))
        while len(rows := np.flatnonzero(feature[self.at] >= 0)):
            at = self.at[rows]
            self.at[rows] = np.where(self.bins[feature[at], rows] > limit[at], right[at], left[at])
        return self.at

    def _gains(self, place, n, growing, chosen):
        """(first place, feature's place, gains by node and bin), of ``NODES_AT_ONCE`` nodes at a time."""
        self._derive()
        slots = place[self._nodes(growing)[: self.n_own]]  # below 0 for other nodes
        for start in range(0, n, NODES_AT_ONCE):
            m = min(NODES_AT_ONCE, n - start)
            rows = np.flatnonzero((slots >= start) & (slots < start + m))
            slot, g, h = slots[rows] - start, self.g[rows], self.h[rows]
            all_g, all_h = (np.bincount(slot, x, m)[:, None] for x in (g, h))
            for c, f in enumerate(chosen):
                width = len(self.borders[f]) + 1
                at = slot * width + self.bins[f][rows]
                low_g, low_h = (np.cumsum(np.bincount(at, x, m * width).reshape(m, width), axis=1)[:, :-1] for x in (g, h))
                gain = self._score(low_g, low_h)
                gain += self._score(all_g - low_g, all_h - low_h)
                gain -= self._score(all_g, all_h)
                # Powers of two, so one product rounds like Grower's two.
                gain = np.trunc(np.multiply(gain, 2.0**20 / UNIT, out=gain), out=gain)
                if self.min_weight:
                    gain[np.minimum(low_h, all_h - low_h) < self.min_weight * UNIT] = 0
                yield start, c, gain

    def _score(self, g, h):
        score = g * g
        score /= h + self.l2 * UNIT
        return score

    def shared_split(self, growing, chosen, with_loss):
        # A node of one row gains nothing by any split.
        full = np.bincount(self._nodes(growing)[: self.n_own], minlength=1 << len(growing.feature)) > 1
        sums = {}
        place = np.where(full, np.cumsum(full) - 1, -1)
        for _, c, gain in self._gains(place, int(full.sum()), growing, chosen):
            sums[c] = sums.get(c, 0) + gain.sum(axis=0)
        found = [(int(x.max()), -c, -int(x.argmax())) for c, x in sums.items() if len(x)]
        gain, c, b = max(found, default=(0, 0, 0))
        return (chosen[-c], -b, gain) if gain > 0 else None, self.losses() if with_loss else (None, None)

    def own_splits(self, growing, chosen, nodes, with_loss):
        place = np.full(len(growing.feature), -1)
        place[nodes] = np.arange(len(nodes))
        best = np.zeros((3, len(nodes)), np.int64)  # gain, feature's place, bin
        for start, c, gain in self._gains(place, len(nodes), growing, chosen):
            if gain.shape[1]:
                b = gain.argmax(axis=1)
                top = gain[np.arange(len(b)), b].astype(np.int64)
                better = np.flatnonzero(top > best[0, start : start + len(b)])
                best[:, start + better] = top[better], np.full(len(better), c), b[better]
        found = {nodes[k]: (chosen[best[1, k]], int(best[2, k]), int(best[0, k])) for k in np.flatnonzero(best[0] > 0)}
        return found, self.losses() if with_loss else (None, None)

    def finish(self, tree, leaves):
        self._derive()
        at = self._nodes(tree)
        g, h = (np.bincount(at[: self.n_own], x, max(leaves) + 1) for x in (self.g, self.h))
        values = np.zeros(max(leaves) + 1)
        values[leaves] = -self.step * g[leaves] / (h[leaves] + self.l2 * UNIT)
        tree.values = array("d", values.tobytes())
        self.margin += values[at]
        self.trees.append(tree)
        self.derived = False

    def losses(self):
        self._derive()
        return self.found


def _grown(grow, grower, options):
    """``_grow`` by a task that holds all rows."""
    borders, base, l2, step, min_weight = grower.borders, grower.base, grower.l2, grower.step, grower.min_weight

    def run(batches):
        few = FewRows(_blocks(batches), borders, base, l2, step, min_weight)
        kept, gains, history = _grow(grow, few, *options)
        told = [(gains, history), *(few.trees[k : min(k + TREES_TOLD, kept)] for k in range(0, kept, TREES_TOLD))]
        for k, part in enumerate(told):
            yield pa.RecordBatch.from_pydict({"part": [k], "held": [zlib.compress(pickle.dumps(part), 1)]})

    # The trees.
    found = sorted(grower.rows.repartition(1).mapInArrow(run, "part long, held binary").collect())
    (gains, history), *trees = (pickle.loads(zlib.decompress(bytes(r["held"]))) for r in found)
    grower.trees = [tree for part in trees for tree in part]
    return len(grower.trees), gains, history


def _oblivious_tree(grower, depth, chosen, gains):
    tree, losses = Tree([], []), (None, None)
    for level in range(depth):
        split, told = grower.shared_split(tree, chosen, level == 0)
        losses = told if level == 0 else losses
        if split is None:
            break
        tree.feature.append(split[0])
        tree.bin.append(split[1])
        gains[split[0]] += split[2]
    return tree, list(range(1 << len(tree.feature))), losses


def _free_tree(grower, depth, chosen, gains):
    tree, losses, open_nodes = Tree([-1], [0], [0], [0]), (None, None), [0]
    for level in range(depth):
        splits, told = grower.own_splits(tree, chosen, open_nodes, level == 0)
        losses, open_nodes = told if level == 0 else losses, []
        for node, (feature, limit, gain) in sorted(splits.items()):
            first = len(tree.feature)
            tree.feature[node], tree.bin[node], tree.left[node], tree.right[node] = feature, limit, first, first + 1
            for column, value in ((tree.feature, -1), (tree.bin, 0), (tree.left, 0), (tree.right, 0)):
                column += [value, value]
            open_nodes += [first, first + 1]
            gains[feature] += gain
        if not open_nodes:
            break
    return tree, [n for n, f in enumerate(tree.feature) if f < 0], losses


def _grow(grow, grower, rounds, depth, feature_share, patience, seed, held):
    """Grow trees until ``rounds`` or, with a held-out part, ``patience`` rounds without a better loss.

    Returns how many to keep, the gains of their features and the losses.
    """
    history, best, n = [], 0, len(grower.columns)
    gains = [[0.0] * n]
    for k in range(rounds + 1):
        chosen = sorted(random.Random(seed * 1_000_003 + k).sample(range(n), max(1, round(feature_share * n))))
        if k == rounds:
            history.append(grower.losses())
        else:
            own = [0.0] * n
            tree, leaves, losses = grow(grower, depth, chosen, own)
            history.append(losses)
        if held and history[-1][1] is not None:
            if history[-1][1] < history[best][1]:
                best = k
            elif k - best >= patience:
                break
        if k < rounds:
            grower.finish(tree, leaves)
            gains.append(own)
    kept = best if held else len(grower.trees)
    return kept, [sum(column) for column in zip(*gains[: kept + 1])], history


def _fit(grow, grower, *options):
    kept, importance, history = (_grown(grow, grower, options) if grower.few else _grow(grow, grower, *options))
    return BoostedTrees(grower.columns, grower.borders, grower.base, grower.trees[:kept], importance, history)


class BoostedTrees:
    """A fitted ensemble: borders of the bins, starting margin, trees.

    ``history`` has the (train, held-out) losses with 0, 1, 2 ... trees; it may go
    beyond the trees kept.
    """

    def __init__(self, columns, borders, base, trees, gains, history):
        self.columns, self.borders, self.base = list(columns), borders, base
        self.trees, self.gains, self.history = trees, gains, history

    def margins(self, values):
        """Margins of a matrix of feature values."""
        bins = np.stack([bin_numbers(values[:, k], edges) for k, edges in enumerate(self.borders)], axis=1)
        total = np.full(len(values), self.base)
        for tree in self.trees:
            total += np.array(tree.values)[tree.leaves(bins)]
        return total

    def _native_margin(self):
        """Oblivious trees as look-ups by the bits of their splits, in whole-stage code."""

        def bit(level, feature, limit):
            # A bin beyond the last border holds all values: no row lies above it.
            edges = self.borders[feature]
            above = F.col(self.columns[feature]) > F.lit(edges[limit]) if limit < len(edges) else F.lit(False)
            return F.when(above, 1 << level).otherwise(0)

        def value(tree):
            index = reduce(lambda a, b: a + b, [bit(k, f, b) for k, (f, b) in enumerate(zip(tree.feature, tree.bin))], F.lit(1))
            return F.element_at(F.array(*map(F.lit, tree.values)), index)

        return F.aggregate(F.array(F.lit(0.0), *map(value, self.trees)), F.lit(self.base), lambda a, b: a + b)

    def _python_margin(self):
        @F.pandas_udf("double")
        def margin(values: pd.DataFrame) -> pd.Series:
            return pd.Series(self.margins(values.to_numpy(float)))

        return margin(F.struct(*[F.col(c).cast("double").alias(c) for c in self.columns]))

    def transform(self, df):
        """Add ``probability`` and ``prediction``; features must not be null."""
        native = all(tree.left is None for tree in self.trees) and sum(len(tree.values) for tree in self.trees) <= NATIVE_VALUES
        chance = 1.0 / (1.0 + F.exp(-(self._native_margin() if native else self._python_margin())))
        scored = df.withColumn("p", chance)
        return scored.withColumns({
            "probability": array_to_vector(F.array(1.0 - F.col("p"), F.col("p"))),
            "prediction": (F.col("p") >= 0.5).cast("double"),
        }).drop("p")

    @property
    def feature_importances(self):
        """Each feature's share of the summed gains."""
        total = sum(self.gains)
        return np.array(self.gains) / (total or 1)

    def save(self, path):
        """Write one row a tree, and one row of what they share, below ``path``."""
        spark = SparkSession.getActiveSession()
        rows = [(k, t.feature, t.bin, t.left, t.right, t.values) for k, t in enumerate(self.trees)]
        numbers = "feature array<int>, bin array<int>, left array<int>, right array<int>, values array<double>"
        spark.createDataFrame(rows, f"tree int, {numbers}").write.mode("overwrite").parquet(f"{path}/trees")
        shared = [(self.columns, self.borders, self.base, list(map(float, self.gains)), [list(x) for x in self.history])]
        kinds = "columns array<string>, borders array<array<double>>, base double, gains array<double>, history array<array<double>>"
        spark.createDataFrame(shared, kinds).write.mode("overwrite").parquet(f"{path}/boosting")

    @classmethod
    def load(cls, path):
        spark = SparkSession.getActiveSession()
        shared = spark.read.parquet(f"{path}/boosting").first()
        rows = spark.read.parquet(f"{path}/trees").orderBy("tree").collect()
        trees = [Tree(r["feature"], r["bin"], r["left"], r["right"], r["values"]) for r in rows]
        return cls(shared["columns"], shared["borders"], shared["base"], trees, shared["gains"], [tuple(x) for x in shared["history"]])


def fit_oblivious_trees(
    train, validation=None, rounds=2000, depth=13, step=0.02, l2=3.0, n_bins=64, patience=50, seed=42, columns=MODEL_FEATURES
):
    """Boosted trees whose nodes share one split a level."""
    grower = Grower(train, validation, columns, n_bins, l2, step)
    return _fit(_oblivious_tree, grower, rounds, depth, 1.0, patience, seed, validation is not None)


def fit_free_trees(
    train, validation=None, rounds=300, depth=15, step=0.02, feature_share=0.4, l2=1.0, min_weight=1.0, n_bins=64,
    patience=20, seed=42, columns=MODEL_FEATURES,
):
    """Boosted trees whose nodes split for themselves, each tree on a random share of the features."""
    grower = Grower(train, validation, columns, n_bins, l2, step, min_weight)
    return _fit(_free_tree, grower, rounds, depth, feature_share, patience, seed, validation is not None)
