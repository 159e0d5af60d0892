"""The mix of some hundred million words and more, whose products with weights pass 32 bits."""

import pytest

from trolley.llm import mixing


@pytest.mark.parametrize("scale", [10**8, 6 * 10**8, 10**12])
def test_targets_keep_their_shares_at_every_size(spark, scale):
    sizes = {"a": 1, "b": 2, "c": 4}
    weights = {"a": 5, "b": 2, "c": 1}
    rows = [(s, n * scale, weights[s]) for s, n in sizes.items()]
    weighted = spark.createDataFrame(rows, "source string, source_size long, weight int")
    got = {r["source"]: r["target"] for r in mixing.targets(weighted).collect()}
    # a, which has too little, is clamped at three times its words; the others share what it leaves.
    assert got == pytest.approx({"a": 3 * scale, "b": 8 / 3 * scale, "c": 4 / 3 * scale})
