"""Toxicity scores by FTRL-proximal logistic regression over hashed word n-grams.

Features are hashed into ``DIMENSIONS`` places: words, their first letters (a
crude stem, for inflected words), neighbouring pairs, and pairs with one word
between. A feature counts once per text. Learning has a rate per coordinate and
an L1 penalty, so only telling features get a weight; these few are broadcast and
every whole text is scored in one pass.

The model is fitted on labelled rows drawn by a keyed hash of doc_id, about
``sample`` of them (all, if there are fewer): a bound on what one task holds, and
the only sample here.

Edge cases: null and empty texts have no features and score as the bias says;
labels that are null, or whose document is missing, are not used; of several
labels for a document the largest counts; without usable labels every score is
0.5 and nothing is rejected. Repeated rows score alike; a null doc_id is never
learned from. Other columns of the input are kept by ``score`` whatever their
names.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trolley.llm.common import fresh, small_batches
from trolley.llm.textscan import column_bytes, groups, mix, word_hashes

BITS = 22
DIMENSIONS = 1 << BITS
STEMS = (4, 6)  # bytes of a word's start
LIMIT = 0.7

# Letters and digits make words; ASCII letters are lower-cased, other ASCII is white space.
_FOLD = bytes(
    c if c >= 128 or chr(c).isdigit() or chr(c).islower() else ord(chr(c).lower()) if chr(c).isupper() else 32
    for c in range(256)
)


def features(texts):
    """Text number and place of every feature of the texts, repeats included."""
    folded = [t.translate(_FOLD) for t in texts]
    owners, words = word_hashes(folded)
    kinds = [(owners, words)]
    for k, prefix in enumerate(STEMS):
        kinds.append((owners, word_hashes(folded, prefix)[1] + np.uint64(k + 1)))
    for gap in (1, 2):
        same = np.flatnonzero(owners[:-gap] == owners[gap:])
        pair = words[same] * np.uint64(0xD6E8FEB86659FD93) + words[same + gap] + np.uint64(gap)
        kinds.append((owners[same], pair))
    return (
        np.concatenate([o for o, _ in kinds]),
        np.concatenate([mix(h) & np.uint64(DIMENSIONS - 1) for _, h in kinds]).astype(np.int64),
    )


def fit(examples, labels, alpha=1.0, beta=1.0, l1=3.0, l2=1.0, epochs=4):
    """Bias and weights (place -> weight) from arrays of distinct places, in order."""
    z, n = np.zeros(DIMENSIONS), np.zeros(DIMENSIONS)
    bias_z = bias_n = 0.0

    def weight(zi, ni, penalty):
        active = np.abs(zi) > penalty
        return np.where(active, (np.sign(zi) * penalty - zi) / ((beta + np.sqrt(ni)) / alpha + l2), 0.0)

    for _ in range(epochs):
        for places, label in zip(examples, labels):
            zi, ni = z[places], n[places]
            w = weight(zi, ni, l1)
            bias = float(weight(bias_z, bias_n, 0.0))
            p = _logistic(w.sum() + bias)
            g = p - label
            after = ni + g * g
            z[places] = zi + g - (np.sqrt(after) - np.sqrt(ni)) / alpha * w
            n[places] = after
            bias_z += g - (np.sqrt(bias_n + g * g) - np.sqrt(bias_n)) / alpha * bias
            bias_n += g * g
    w = weight(z, n, l1)
    places = np.flatnonzero(w)
    return float(weight(bias_z, bias_n, 0.0)), places, w[places]


def _logistic(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))


def score_texts(texts, bias, places, weights):
    """Score of every text."""
    used = np.zeros(DIMENSIONS, bool)
    used[places] = True
    scores = []
    for start, end in groups(texts):
        owners, found = features(texts[start:end])
        hit = used[found]
        keys = np.unique(owners[hit] * DIMENSIONS + found[hit])
        sums = np.bincount(
            keys // DIMENSIONS, weights[np.searchsorted(places, keys % DIMENSIONS)], end - start
        ) if len(keys) else np.zeros(end - start)
        scores.append(_logistic(sums + bias))
    return np.concatenate(scores) if scores else np.zeros(0)


def _example_rows(batches):
    for batch in batches:
        texts = column_bytes(batch, "text")
        rows = []
        for start, end in groups(texts):
            owners, found = features(texts[start:end])
            keys = np.unique(owners * DIMENSIONS + found)
            bounds = np.searchsorted(keys // DIMENSIONS, np.arange(end - start + 1))
            places = (keys % DIMENSIONS).astype(np.int32)
            rows += [places[a:b] for a, b in zip(bounds, bounds[1:])]
        yield pa.RecordBatch.from_arrays(
            [batch.column(batch.schema.get_field_index(c)) for c in ("place", "label")]
            + [pa.array(rows, pa.list_(pa.int32()))],
            names=["place", "label", "places"],
        )


def learn(docs, labels, sample=20_000, seed=11, **settings):
    """Fit on the labelled rows; ``labels`` has doc_id and ``toxic``.

    One task holds the drawn rows' features, about ``sample`` rows of them.
    """
    small_batches(docs.sparkSession)
    place = F.xxhash64(F.lit(seed), F.col("doc_id"))
    known = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(
        F.max("toxic").cast("int").alias("label")
    )
    total = known.count()
    share = min(1.0, sample / max(total, 1))
    drawn = known.withColumn("place", place).filter(F.pmod(F.col("place"), F.lit(1 << 30)) <= int(share * (1 << 30)))
    texts = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"))
    rows = texts.join(F.broadcast(drawn), "doc_id").select("place", "label", "text").mapInArrow(
        _example_rows, "place long, label int, places array<int>"
    )

    def train(batches):
        taken = [(p, y, x.values.to_numpy()) for b in batches
                 for p, y, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2))]
        taken.sort(key=lambda row: row[0])
        if not taken:
            return
        bias, places, weights = fit([x for _, _, x in taken], [y for _, y, _ in taken], **settings)
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1, *places.tolist()], pa.int32()), pa.array([bias, *weights.tolist()], pa.float64())],
            names=["place", "weight"],
        )

    model = rows.repartition(1).mapInArrow(train, "place int, weight double").toPandas().sort_values("place")
    if not len(model):
        return 0.0, np.zeros(0, np.int64), np.zeros(0)
    return (
        float(model["weight"].iloc[0]),
        model["place"].to_numpy()[1:].astype(np.int64),
        model["weight"].to_numpy()[1:],
    )


def score(docs, model, column="score"):
    """``docs`` with the score of each text, 0 to 1."""
    small_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(T.DoubleType())
    def scored(texts: pd.Series) -> pd.Series:
        plain = [t.encode() if isinstance(t, str) else b"" for t in texts]
        return pd.Series(score_texts(plain, *held.value))

    return docs.withColumn(column, scored(F.col("text").cast("string")))


def training_labels(labels):
    """The labels that may be learned from; the others are held out for tests."""
    return labels.filter(~held_out(F.col("doc_id")))


def held_out(doc_id):
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def reject_toxic(docs, labels, limit=LIMIT, **settings):
    """The documents whose score stays below ``limit``, with their columns."""
    (name,) = fresh(docs, "toxic_score")
    model = learn(docs, training_labels(labels), **settings)
    return score(docs, model, name).filter(F.col(name) < limit).drop(name)
