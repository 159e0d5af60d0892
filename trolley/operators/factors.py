"""Non-negative factors of 0/1 flags, for any number of flags.

Rows with equal flags get equal factors, so the distinct flag patterns are written
once, with their counts, and factorised in rounds. Given the column factors, the
best factors of a pattern depend on nothing else: tasks find them by coordinate
descent and add up what the next column factors need, k x k and k x flags sums.
Only those sums reach the driver, which improves the column factors by
multiplicative updates. Neither half can raise the squared error. Patterns stay in
Spark; there may be as many as products.
"""


import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from trolley.session import work_folder

SWEEPS = 200  # coordinate descents of a pattern's factors
UPDATES = 50  # multiplicative updates of the column factors a round
ROUNDS = 12
TINY = np.finfo(float).eps
UNIT = 1 << 12


def row_factors(x, columns):
    """Non-negative factors of the rows of ``x`` with the least squared error, rows one by one."""
    inner, target = columns @ columns.T, x @ columns.T
    found = np.zeros((len(x), len(columns)))
    for _ in range(SWEEPS):
        for j in range(len(columns)):
            rest = target[:, j] - found @ inner[:, j] + found[:, j] * inner[j, j]
            found[:, j] = np.maximum(rest, 0) / max(inner[j, j], TINY)
    return found


def column_factors(columns, inner, outer):
    """Better column factors, given the weighted sums rows'rows and rows'x."""
    for _ in range(UPDATES):
        columns = columns * outer / np.maximum(inner @ columns, TINY)
    return columns


def first_columns(k, n_flags, seed):
    return np.random.default_rng(seed).uniform(0.1, 1.0, (k, n_flags))


def _matrix(batch):
    text = batch.column(0).to_pylist()
    return np.frombuffer("".join(text).encode(), np.uint8).reshape(len(text), -1).astype(float) - ord("0")


def _sums(columns):
    """Per task: the weighted sums of the pattern's factors, as cells, and the error (cell -1)."""
    k = len(columns)

    def run(batches):
        cells = np.zeros(k * k + columns.size + 1, np.int64)
        for batch in batches:
            x, n = _matrix(batch), batch.column(1).to_numpy()[:, None]
            rows = np.rint(row_factors(x, columns) * UNIT).astype(np.int64)
            error = np.rint((x - rows @ columns / UNIT) ** 2 * UNIT).astype(np.int64)
            parts = ((rows * n).T @ rows, (rows * n).T @ x.astype(np.int64), (error * n).sum())
            cells += np.concatenate([np.ravel(part) for part in parts])
        yield pa.RecordBatch.from_pydict({"cell": pa.array(np.arange(len(cells))), "value": pa.array(cells)})

    return run


def _scaled(columns):
    def run(batches):
        for batch in batches:
            x = _matrix(batch)
            rows = row_factors(x, columns)
            rows[~x.any(axis=1)] = 0.0
            norms = np.linalg.norm(rows, axis=1, keepdims=True)
            unit = np.divide(rows, norms, out=np.zeros_like(rows), where=norms > 0)
            arrays = [batch.column(0), *[pa.array(np.ascontiguousarray(c)) for c in unit.T]]
            yield pa.RecordBatch.from_arrays(arrays, names=["pattern", *[f"f{j}" for j in range(len(columns))]])

    return run


def factorise(patterns, n_flags, k, seed, rounds=ROUNDS):
    """Column factors of a table (pattern, n), and the error before each round.

    Row factors enter the sums as whole numbers of 2^-12, so the dealing of rows does
    not matter; sums are exact up to 10^11 rows.
    """
    columns, errors = first_columns(k, n_flags, seed), []
    for _ in range(rounds):
        cells = patterns.mapInArrow(_sums(columns), "cell long, value long").groupBy("cell").agg(F.sum("value").alias("value"))
        found = np.zeros(k * k + k * n_flags + 1)
        for r in cells.collect():  # one number a cell of the sums
            found[r["cell"]] = r["value"] / UNIT
        errors.append(found[-1])
        inner, outer = found[: k * k].reshape(k, k) / UNIT, found[k * k : -1].reshape(k, n_flags)
        columns = column_factors(columns, inner, outer)
    return columns, errors


def pattern_factors(flagged, names, k=3, seed=42, prefix="factor_", key="product_id", rounds=ROUNDS):
    """``k`` factors per row, scaled to unit length; rows without flags stay zero."""
    spark = flagged.sparkSession
    coded = flagged.select(key, F.concat(*[F.coalesce(name, F.lit(0)).cast("string") for name in names]).alias("pattern"))
    folder = work_folder(spark, "factors")
    coded.groupBy("pattern").agg(F.count("*").alias("n")).write.parquet(f"{folder}/patterns")
    patterns = spark.read.parquet(f"{folder}/patterns")
    columns, _ = factorise(patterns, len(names), k, seed, rounds)
    kinds = ", ".join(["pattern string", *[f"f{j} double" for j in range(k)]])
    patterns.mapInArrow(_scaled(columns), kinds).write.parquet(f"{folder}/factors")
    lookup = spark.read.parquet(f"{folder}/factors")
    return coded.join(lookup, "pattern").select(key, *[F.col(f"f{j}").alias(f"{prefix}{j + 1}") for j in range(k)])
