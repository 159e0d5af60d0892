"""Shards of nearly equal bytes by histogram sort.

Rows are sorted by a key made from their text, so copies of a text lie together,
and cut where the bytes below a key reach each shard's share. The cuts come from
rounds: all tasks count the exact bytes and rows below candidate keys, and new
candidates go between the two counted ones around each wanted number, until the
nearest is within the tolerance. Only counts per candidate reach the driver. Then
every row moves once, to its part of its shard, and is sorted there.

Groups of equal texts stay whole. Those that hold more than the tolerance of a
shard cannot be cut around, and there are fewer than shards / tolerance of them:
they are dealt first, the largest to the emptiest shard, and the cuts give each
shard the bytes it still lacks. A group of more than a whole shard is the one
that must be split; its rows are placed one by one.

A shard is made of parts of about ``part_bytes``, each one task of the exchange, so
neither a shard nor a group has to fit into one. Rows below a part's start are
known from the counts, so a row's slot is that number and its place in the part.

Edge cases: a null text has no bytes and is one group with the empty text; every
row counts its bytes plus 1. Repeated rows are rows of their own with slots of
their own; null and repeated doc_ids are fine. Texts of fewer than ``n_shards``
groups leave shards empty; an empty table gives an empty result. All columns are
kept, whatever their names; ``shard`` and ``slot`` take underscores in front where
taken. The input is written once below the shared folder, so all passes see the
same rows even if it would not come out the same twice.
"""

import bisect
import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from trolley.llm.common import fresh, stored

TOLERANCE = 0.005
PART_BYTES = 1 << 25
PROBES = 8  # new candidates for each cut and round
LOW_KEYS = 1 << 61  # keys of cut rows; those of dealt groups follow
TOP_KEYS = 1 << 60  # of all dealt groups together


def text_bytes(text):
    """UTF-8 bytes of a text, 0 for null, plus 1."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def deal(large, n_shards):
    """Shard of each (group, bytes), largest first to the emptiest; and the bytes given to each shard."""
    given = [(0, shard) for shard in range(n_shards)]
    placed = {}
    for group, size in sorted(large, key=lambda x: (-x[1], x[0])):
        total, shard = heapq.heappop(given)
        placed[group] = shard
        heapq.heappush(given, (total + size, shard))
    return placed, [total for total, _ in sorted(given, key=lambda x: x[1])]


def room(total, given):
    """Bytes each shard still takes so that all end as equal as the given ones allow."""
    left, open_shards = total - sum(given), sorted(range(len(given)), key=lambda s: given[s])
    while open_shards and len(open_shards) * given[open_shards[-1]] > left + sum(given[s] for s in open_shards):
        open_shards.pop()
    level = (left + sum(given[s] for s in open_shards)) / max(len(open_shards), 1)
    return [level - g if s in set(open_shards) else 0.0 for s, g in enumerate(given)]


def _below(probes):
    """Bytes and rows whose key lies from each candidate up to the next one."""
    edges = np.array(probes, np.int64)

    def run(batches):
        size, rows = np.zeros(len(edges) + 1, np.int64), np.zeros(len(edges) + 1, np.int64)
        for batch in batches:
            at = np.searchsorted(edges, batch.column(0).to_numpy(), "right")
            np.add.at(size, at, batch.column(1).to_numpy())
            rows += np.bincount(at, minlength=len(rows))
        full = np.flatnonzero(rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array(full), pa.array(size[full]), pa.array(rows[full])], names=["at", "size", "n"]
        )

    return run


def count_below(keys, probes):
    """(bytes, rows) below each of the sorted keys ``probes``, counted over all rows of ``keys``."""
    counted = keys.select("key", "size").mapInArrow(_below(probes), "at long, size long, n long")
    found = {r["at"]: r for r in counted.groupBy("at").agg(F.sum("size").alias("size"), F.sum("n").alias("n")).collect()}
    below, size, n = {}, 0, 0
    for i, probe in enumerate(probes):
        if i in found:
            size, n = size + found[i]["size"], n + found[i]["n"]
        below[probe] = (size, n)
    return below


def cuts(keys, wanted, known):
    """The key at which the bytes below are nearest to each wanted number.

    ``wanted`` has (bytes, tolerance, low key, high key); ``known`` maps keys to
    (bytes, rows) below them, holds the low and high ones, and takes up every
    count on the way. A cut is final within its tolerance, or between two
    neighbouring keys.
    """
    spans = [[low, high] for _, _, low, high in wanted]
    opened = list(range(len(wanted)))
    while opened:
        new, still = set(), []
        for k in opened:
            (low, high), (goal, allowed) = spans[k], wanted[k][:2]
            if high - low <= 1 or min(abs(known[key][0] - goal) for key in (low, high)) <= allowed:
                continue
            still.append(k)
            # Keys are hashes, so the bytes between two candidates lie about evenly.
            share = (goal - known[low][0]) / max(known[high][0] - known[low][0], 1)
            middle = low + int(share * (high - low))
            width = max(1, (high - low) // (4 * PROBES))
            near = [middle + width * d for d in range(-PROBES // 4, PROBES // 4 + 1)]
            even = [low + (high - low) * d // (PROBES // 2) for d in range(1, PROBES // 2)]
            new.update(min(max(x, low + 1), high - 1) for x in near + even)
        opened = still
        new = sorted(x for x in new if x not in known)
        if new:
            known.update(count_below(keys, new))
        for k in opened:
            low, high = spans[k]
            for x in new[bisect.bisect_right(new, low) : bisect.bisect_left(new, high)]:
                if known[x][0] <= wanted[k][0]:
                    low = max(low, x)
                else:
                    high = min(high, x)
            spans[k] = [low, high]
    return [min(span, key=lambda key: abs(known[key][0] - w[0])) for span, w in zip(spans, wanted)]


def _key(n_shards):
    """Key of a row from its group (h), its dealt shard or null, whether it is loose, and its own hash."""
    width = TOP_KEYS // n_shards
    low = F.when(F.col("loose"), F.col("own")).otherwise(F.col("h"))
    dealt = F.lit(LOW_KEYS) + F.col("to") * F.lit(width) + F.pmod("own", F.lit(width))
    return F.when(F.col("to").isNotNull(), dealt).otherwise(F.pmod(low, F.lit(LOW_KEYS)))


def _parts_of(keys, n_shards, given, allowed, part_bytes):
    """First key, shard and rows before in the shard, for every part in ascending order of keys."""
    width = TOP_KEYS // n_shards
    edges = [0, *[LOW_KEYS + s * width for s in range(n_shards)], 1 << 62]
    known = count_below(keys, edges)
    loose_bytes = known[LOW_KEYS][0]
    lacking = room(known[1 << 62][0], given)
    # First the shards' cuts of the rows not dealt, then the parts' inside each shard.
    goals = np.cumsum(lacking)[:-1] * (loose_bytes / max(sum(lacking), 1))
    shard_cuts = np.maximum.accumulate(cuts(keys, [(g, allowed, 0, LOW_KEYS) for g in goals.tolist()], known)).tolist()
    regions = list(zip(range(n_shards), [0, *shard_cuts], [*shard_cuts, LOW_KEYS]))
    regions += list(zip(range(n_shards), edges[1:-1], edges[2:]))
    wanted = []
    for _, low, high in regions:
        size = known[high][0] - known[low][0]
        n = max(1, math.ceil(size / part_bytes))
        wanted += [(known[low][0] + size * d / n, part_bytes / 8, low, high) for d in range(1, n)]
    inner = sorted(set(cuts(keys, wanted, known)))
    parts, before = [], [0] * n_shards
    for shard, low, high in regions:
        marks = sorted({low, *[x for x in inner if low < x < high], high}) if high > low else []
        for first, last in zip(marks, marks[1:]):
            rows = known[last][1] - known[first][1]
            if rows:
                parts.append((first, shard, before[shard]))
                before[shard] += rows
    return sorted(parts)


def shard_documents(docs, n_shards=16, tolerance=TOLERANCE, part_bytes=PART_BYTES, text="text"):
    """The rows of ``docs`` with ``shard`` and ``slot``, gapless from 0 in each shard.

    Shards have equal bytes up to ``tolerance``, as far as whole groups of equal
    texts and single rows allow. Rows come sorted by shard part, ready to be written.
    """
    spark = docs.sparkSession
    shard, slot = fresh(docs, "shard", "slot")
    plain = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
    body = F.coalesce(F.col(f"c{docs.columns.index(text)}").cast("string"), F.lit(""))
    keyed = stored(
        plain.withColumns({"size": text_bytes(body), "h": F.xxhash64(body)})
        .withColumn("own", F.xxhash64("h", F.monotonically_increasing_id())),
        "shard_rows",
    )
    groups = keyed.groupBy("h").agg(F.sum("size").alias("bytes"))
    total = keyed.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    mean = total / n_shards
    # Each holds over ``tolerance`` of a shard, so there are fewer than n_shards / tolerance.
    large = [(r["h"], r["bytes"]) for r in groups.filter(F.col("bytes") > mean * tolerance).collect()]
    placed, given = deal([x for x in large if x[1] <= mean], n_shards)
    rows = [(h, placed.get(h), h not in placed) for h, _ in large]
    known = spark.createDataFrame(rows, "h long, to int, split boolean")
    marked = keyed.join(F.broadcast(known), "h", "left").withColumn("loose", F.coalesce("split", F.lit(False)))
    marked = marked.withColumn("key", _key(n_shards))
    keys = stored(marked.select("key", "size"), "shard_keys")
    parts = _parts_of(keys, n_shards, given, mean * tolerance / 2, part_bytes)
    if not parts:
        return docs.limit(0).select("*", F.lit(0).alias(shard), F.lit(0).cast("long").alias(slot))
    # One entry a part: their number is bounded by the bytes / part_bytes and the shards.
    firsts, shards, before = (np.array(c) for c in zip(*parts))

    @F.pandas_udf("part int, shard int, before long")
    def place(key):
        import pandas as pd

        at = np.searchsorted(firsts, key.to_numpy(), "right") - 1
        return pd.DataFrame({"part": at.astype(np.int32), "shard": shards[at].astype(np.int32), "before": before[at]})

    dealt = marked.withColumn("at", place("key")).select(*plain.columns, "key", "own", "at")
    moved = dealt.repartitionById(len(parts), F.col("at.part")).sortWithinPartitions("key", "own")
    inside = F.monotonically_increasing_id() % F.lit(1 << 33)
    result = moved.select(*plain.columns, F.col("at.shard"), (F.col("at.before") + inside).alias("slot"))
    return result.toDF(*docs.columns, shard, slot)


def write_shards(sharded, folder, shard="shard"):
    """Write a sharded table below ``folder``: a subfolder a shard, a file or more a part, rows by slot."""
    sharded.write.partitionBy(shard).parquet(folder)
    return folder
