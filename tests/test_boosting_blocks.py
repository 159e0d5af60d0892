"""Rows handed over in blocks."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from trolley.operators import boosting
from trolley.schema import LABEL


def test_blocks_give_their_rows_back(monkeypatch):
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 4)
    rows = pa.RecordBatch.from_pydict({"bins": [bytes([k, 1]) for k in range(11)], "label": [float(k) for k in range(11)]})
    packed = list(boosting._packed(iter)([rows.slice(0, 0), rows.slice(1, 10)]))
    assert [b.num_rows for b in packed] == [1, 1, 1]
    found = list(boosting._blocks(packed))
    assert [b.num_rows for b in found] == [4, 4, 2]
    assert np.concatenate([boosting._matrix(b.column(0), 2)[:, 0] for b in found]).tolist() == list(range(1, 11))
    assert [x for b in found for x in b.column(1).to_pylist()] == list(range(1, 11))


def test_a_pass_reads_few_rows(spark):
    rows = spark.range(3000).select(F.col("id").cast("double").alias("x"), (F.col("id") % 2).cast("double").alias(LABEL))
    grower = boosting.Grower(rows, rows.limit(100), ["x"], 16, 1.0, 0.3)
    assert grower.rows.count() < 31
    assert sum(r["n"] for r in grower._summed(boosting.Tree([], []), [0], [0], 16).filter("slot = 15").collect()) == 3000
