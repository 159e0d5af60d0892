"""Bins as Arrow buffers."""

import numpy as np
import pyarrow as pa

from trolley.operators import boosting


def test_bins_are_read_from_slices():
    bins = np.arange(40, dtype=np.uint8).reshape(10, 4)
    column = pa.array([r.tobytes() for r in bins], pa.binary())
    assert (boosting._matrix(column.slice(3, 5), 4) == bins[3:8]).all()
    assert boosting._matrix(column.slice(0, 0), 4).shape == (0, 4)
    batch = pa.RecordBatch.from_arrays(
        [pa.array([0.5, 1.5, 2.5]), pa.array([9.0, 0.0, 1.0]), pa.array([1.0, 0.0, 1.0])], names=["a", "b", "label"]
    )
    (made,) = boosting._binned([[1.0, 2.0], [0.5]])(iter([pa.RecordBatch.from_arrays([*batch.columns, *batch.columns[1:]], names=list("abcde"))]))
    assert made.column(0).to_pylist() == [bytes([0, 1]), bytes([1, 0]), bytes([2, 1])]
