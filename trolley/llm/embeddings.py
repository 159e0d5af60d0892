"""Near-duplicates of embeddings by cross-polytope hashing.

Vectors, padded with zeros to a power of two, pass three rounds of random signs
and a fast Hadamard transform; the hash is the coordinate of largest size with its
sign. A table's bucket joins ``k`` such hashes, and every vector enters its own
bucket and the ``PROBES - 1`` nearest others. ``k`` follows from the number of
vectors, so buckets stay small; the number of tables follows from the measured
chance that two vectors exactly at the wanted cosine share a bucket.

Candidates are verified by their cosine in double precision. A pair that shares
several buckets counts in the smallest only, so links are counted where they are
found and never listed; out of a bucket come link counts and enough links to
connect it. Large buckets are cut into blocks whose pairs go to different tasks.
Equal vectors are one class from the start.

Edge cases: a vector that is null, empty, zero, or holds null or non-finite
components links with nothing and is its own component; vectors of different
lengths never link; rows that share a vec_id are one node, whose different vectors'
links are counted together; a null vec_id links with nothing and is kept. An empty table
gives an empty result. Other columns are ignored.
"""

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from trolley.llm.common import stored
from trolley.llm.components import components

PROBES = 4
RECALL = 0.999
BLOCK = 1024
DEPTH = 3  # coordinates of each hash that probing may choose from


def _hadamard(x):
    n, half = x.shape[1], 1
    while half < n:
        y = x.reshape(len(x), n // (2 * half), 2, half)
        x = np.stack((y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]), axis=2).reshape(len(x), n)
        half *= 2
    return x


class Hashes:
    """``tables`` tables of ``k`` hashes for vectors of one length."""

    def __init__(self, length, tables, k, seed=5):
        self.size = 1 << max(1, (length - 1).bit_length())
        rng = np.random.default_rng([seed, self.size, k])
        self.signs = rng.choice(np.array([-1.0, 1.0]), size=(tables, k, 3, self.size))
        self.choices = np.array(list(itertools.product(range(min(DEPTH, self.size)), repeat=k)))

    def codes(self, vectors):
        """Per vector, its buckets: ``PROBES`` numbers for each table."""
        padded = np.zeros((len(vectors), self.size))
        padded[:, : vectors.shape[1]] = vectors
        found = []
        for t, table in enumerate(self.signs):
            loss = code = 0
            for j, rounds in enumerate(table):
                x = padded
                for signs in rounds:
                    x = _hadamard(x * signs)
                x /= math.sqrt(self.size) ** 3
                size = np.abs(x)
                best = np.argsort(-size, axis=1, kind="stable")[:, :DEPTH]
                height = np.take_along_axis(size, best, 1)
                side = best * 2 + (np.take_along_axis(x, best, 1) < 0)
                pick = self.choices[:, j]
                loss = loss + (height[:, :1] - height[:, pick]) ** 2
                code = code * (2 * self.size) + side[:, pick]
            near = np.argsort(loss, axis=1, kind="stable")[:, :PROBES]
            found.append(np.take_along_axis(code, near, 1) * len(self.signs) + t)
        return np.concatenate(found, axis=1).astype(np.int64)


def table_count(length, k, cosine):
    """Tables for which a pair at the cosine shares a bucket with probability ``RECALL``."""
    rng = np.random.default_rng(9)
    a, b = rng.normal(size=(2, 2000, length))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(1, keepdims=True) * a
    b /= np.maximum(np.linalg.norm(b, axis=1, keepdims=True), 1e-12)
    b = cosine * a + math.sqrt(1 - cosine**2) * b
    trial = Hashes(length, 8, k, seed=77)
    x, y = (trial.codes(v).reshape(2000, 8, -1) for v in (a, b))
    chance = (x[:, :, :, None] == y[:, :, None, :]).any((2, 3)).mean()
    return max(1, math.ceil(math.log(1 - RECALL) / math.log(max(1e-9, 1 - chance))))


def _matrix(column, kind=np.float64):
    return np.asarray(column.flatten()).astype(kind).reshape(len(column), -1)


def _coded(length, tables, k):
    def run(batches):
        hashes = Hashes(length, tables, k)
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                part = batch.slice(start, 2048)
                vectors = _matrix(part.column(2))
                codes = hashes.codes(vectors / np.linalg.norm(vectors, axis=1, keepdims=True))
                flat = pa.array(codes.ravel())
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(codes) + 1, dtype=np.int32) * codes.shape[1]), flat)
                yield pa.RecordBatch.from_arrays([*part.columns, lists], names=["rep", "copies", "vector", "codes"])

    return run


class _Bucket:
    """Rows of one cell of a bucket: ids, copies, unit vectors, codes, and the block they come from."""

    def __init__(self, cosine):
        self.cosine = cosine

    def links(self, code, rows):
        """(rep, links counted here, link that connects it or -1) of a cell."""
        ids, copies, vectors, codes, block = rows
        blocks = np.unique(block)
        # A cell of two blocks has the pairs between them, a cell of one its own pairs.
        left = block == blocks[0]
        right = ~left if len(blocks) > 1 else left
        a, b = np.flatnonzero(left), np.flatnonzero(right)
        count, parent = np.zeros(len(ids), np.int64), np.full(len(ids), -1, np.int64)
        for start in range(0, len(a), 256):
            part = a[start : start + 256]
            hit = vectors[part] @ vectors[b].T >= self.cosine
            i, j = np.nonzero(hit)
            i, j = part[i], b[j]
            if len(blocks) == 1:
                keep = i < j
                i, j = i[keep], j[keep]
            for cut in range(0, len(i), 20_000):
                x, y = i[cut : cut + 20_000], j[cut : cut + 20_000]
                same = codes[x][:, :, None] == codes[y][:, None, :]
                first = np.where(same.any(2), codes[x], np.iinfo(np.int64).max).min(1)
                own = first == code
                x, y = x[own], y[own]
                np.add.at(count, x, copies[y])
                np.add.at(count, y, copies[x])
                # Each row keeps one link to the smallest row it met; more are needed to connect all.
                for p, q in _forest(x, y, parent):
                    yield ids[p], 0, ids[q]
        for n in np.flatnonzero(count):
            yield ids[n], count[n], -1


def _forest(x, y, parent):
    """Those of the links (x, y) that join parts not joined before; ``parent`` holds the parts."""
    def top(n):
        while parent[n] >= 0:
            if parent[parent[n]] >= 0:
                parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    if not len(x):
        return
    order = np.lexsort((x, y))
    for p, q in zip(x[order].tolist(), y[order].tolist()):
        if parent[p] >= 0 and parent[p] == parent[q]:
            continue
        r, s = top(p), top(q)
        if r != s:
            parent[max(r, s)] = min(r, s)
            yield p, q


def _compared(cosine):
    def run(batches):
        bucket = _Bucket(cosine)
        now, held = None, []
        out = []

        def close():
            if len(held) and sum(len(h[0]) for h in held) > 1:
                out.extend(bucket.links(now[0], [np.concatenate(c) for c in zip(*held)]))
            held.clear()

        for batch in batches:
            keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            cuts = [0, *[i for i in range(1, len(keys)) if keys[i] != keys[i - 1]], len(keys)]
            ids, copies, block = (np.asarray(batch.column(k)) for k in (3, 4, 2))
            vectors, codes = _matrix(batch.column(5)), _matrix(batch.column(6), np.int64)
            vectors = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
            for start, end in zip(cuts, cuts[1:]):
                if end > start:
                    if keys[start] != now:
                        close()
                        now = keys[start]
                    held.append((ids[start:end], copies[start:end], vectors[start:end], codes[start:end], block[start:end]))
            if len(out) > 10_000:
                yield _rows(out)
                out.clear()
        close()
        if out:
            yield _rows(out)

    return run


def _rows(out):
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["rep", "n", "other"])


def usable(vector):
    """Whether a vector has a direction: finite components, not all zero."""
    finite = ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def near_vectors(table, cosine=0.9):
    """vec_id, n_links, component_id and kept for every row (vec_id, embedding)."""
    kind = "float" if table.schema["embedding"].dataType.elementType.typeName() == "float" else "double"
    rows = table.select(F.col("vec_id").cast("long"), F.col("embedding").cast(f"array<{kind}>").alias("vector"))
    # Adding zero makes -0.0 and 0.0 one.
    rows = stored(rows.select(
        "vec_id", F.when(usable(F.col("vector")) & F.col("vec_id").isNotNull(), F.transform("vector", lambda x: x + F.lit(0.0).cast(kind))).alias("vector")
    ), "vec_rows")
    classes = stored(
        rows.filter("vector is not null").groupBy("vector").agg(
            F.min("vec_id").alias("rep"), F.count("*").alias("copies")
        ), "vec_classes",
    )
    sizes = classes.groupBy(F.size("vector").alias("length")).agg(F.count("*").alias("n"))
    counts = links = None
    for length, n in sorted(map(tuple, sizes.collect())):  # one row per length of a vector
        found = stored(_links(classes.filter(F.size("vector") == length), length, n, cosine), "vec_links")
        own = found.filter("n > 0").groupBy("rep").agg(F.sum("n").alias("n"))
        joined = found.filter("n = 0").select(F.col("rep").alias("a"), F.col("other").alias("b"))
        counts = own if counts is None else counts.unionByName(own)
        links = joined if links is None else links.unionByName(joined)
    if counts is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    labels = components(links)
    counts = counts.withColumnRenamed("rep", "counted")
    known = stored(classes.join(counts, F.col("rep") == F.col("counted"), "left").join(labels, F.col("rep") == F.col("node"), "left").select(
        F.col("vector").alias("own"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"),
    ), "vec_known")
    component = F.coalesce("component_id", "vec_id")
    return rows.join(known, F.col("vector") == F.col("own"), "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"),
    )


def _links(classes, length, n, cosine):
    """Link counts (rep, n, -1) and connecting links (rep, 0, other) of equally long vectors."""
    side = 2 * (1 << max(1, (length - 1).bit_length()))
    k = max(1, round(math.log(max(n, 2)) / math.log(side)))
    tables = table_count(length, k, cosine)
    coded = stored(
        classes.select("rep", "copies", "vector").mapInArrow(
            _coded(length, tables, k), f"rep long, copies long, vector {classes.schema['vector'].dataType.simpleString()}, codes array<long>"
        ), "vec_codes",
    )
    mark = F.xxhash64("vector").alias("mark")  # tells vectors under one number apart
    members = coded.select("rep", mark, F.explode(F.array_distinct("codes")).alias("code"))
    shared = members.groupBy("code").agg(F.count("*").alias("n")).filter("n > 1").select(
        "code", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")
    )
    # A block meets itself and every other block of its bucket, each pair in one cell.
    block = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    cell = F.least("block", "other") * F.col("blocks") + F.greatest("block", "other")
    cells = members.join(shared, "code").withColumn("block", block).withColumn("other", other).select(
        "code", cell.alias("cell"), "block", "rep", "mark"
    )
    rows = cells.join(coded.withColumn("mark", mark), ["rep", "mark"]).select("code", "cell", "block", "rep", "copies", "vector", "codes")
    spread = rows.repartition("code", "cell").sortWithinPartitions("code", "cell")
    return spread.mapInArrow(_compared(cosine), "rep long, n long, other long")
