"""Pairs below the limit are told apart before their texts are compared."""

import numpy as np
from pyspark.sql import functions as F

from trolley.llm import near_duplicates as near

PERCENT = 85


def test_a_group_just_below_the_limit_is_hardly_compared(spark, monkeypatch):
    rng = np.random.default_rng(5)
    base, rows = [f"w{k}" for k in range(300)], []
    for i in range(40):
        words = list(base)
        for at in rng.choice(np.arange(5, 295, 12), 3, replace=False):
            words[at] = f"own{i}x{at}"
        rows.append((i, " ".join(words)))
    rows += [(100 + i, text.replace("w299", f"end{i}")) for i, text in rows[:10]]  # copies to be linked
    compared, plain = [], near.similar_pairs

    def counted(texts, pairs, percent):
        compared.append(pairs.count())
        return plain(texts, pairs, percent)

    monkeypatch.setattr(near, "similar_pairs", counted)
    found = near.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), PERCENT)
    sets = dict(zip([i for i, _ in rows], near.shingle_sets([t.encode() for _, t in rows])))
    label, links = {i: i for i in sets}, 0
    for a in sets:
        for b in sets:
            both = len(np.intersect1d(sets[a], sets[b]))
            if 100 * both >= PERCENT * (len(sets[a]) + len(sets[b]) - both):
                links += a < b
                one, other = label[a], label[b]
                label = {k: min(one, other) if v in (one, other) else v for k, v in label.items()}
    assert {r["doc_id"]: r["component_id"] for r in found.collect()} == label
    assert len(set(label.values())) > 10 and links < 100 and sum(compared) < 400  # of 1225 pairs


def test_similar_sets_stay_within_the_limit(spark):
    rng = np.random.default_rng(6)
    sizes = [20, 37, 100, 740, 3700, 18500]
    for n in sizes:
        d = 2 * n * (100 - PERCENT) // (100 + PERCENT) // 2  # own shingles of each side
        limit = spark.range(1).select(near.odd_limit(F.lit(2 * n), PERCENT)).first()[0]
        for _ in range(20):
            hashes = rng.integers(0, 2**63, n + d, dtype=np.uint64)
            owners = np.repeat([0, 1, 3], n)
            made = near.odd_sketches(owners, np.concatenate([hashes[:n], hashes[d:], hashes[:n]]), 4)
            differ = sum(int(x).bit_count() for x in (made[0] ^ made[1]).view(np.uint64))
            assert differ <= min(limit, 2 * d) and (made[0] == made[3]).all() and not made[2].any()
