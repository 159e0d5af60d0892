"""MinHash near-duplicates of texts, with tensored banding.

A text's set is its distinct shingles of five words (fewer words: the whole
sequence). Two small collections of ``m`` hash keys each, every key made of
``WIDTH`` minhashes, are combined pair by pair into m * m table keys: as many
tables as 2 * m * WIDTH minhashes would never give one by one. Candidates share a
table key, and so many of the minhashes themselves, told by seven bits of each, as
a pair at the wanted similarity does for all but a few in ten thousand. Of those, the
ones whose odd sketches (bit h of ``ODD`` flipped by every shingle of hash h) differ in
more bits than so similar sets do are left out. ``m``
follows from the similarity, so that a pair exactly at it is a candidate with
probability ``RECALL`` or more.

Equal sets are one class from the start. In each bucket the class that shares most
buckets with others leads and is compared with the rest, for the text that others
were made from is the likeliest to link with all of them. Then the next leads, and
then ever more at once, but only across components that are still apart: a bucket
of one component is done, so a big group of near copies costs about one comparison
per member. A class that has led has met its whole bucket and leaves it.
Every comparison uses the full sets, recomputed from the texts; no pair of a bucket
is left out unless it is already known to be connected or its sizes rule it out.

Edge cases: texts that are null or have no words have an empty set and link with
nothing; a null doc_id links with nothing, has no component and is kept. Rows that
repeat a doc_id are judged by their texts, each of which is compared with others.
``drop_near_duplicates`` removes a doc_id if none of its rows is kept, and keeps all
columns whatever their names. Empty tables give empty results.
"""

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trolley.llm.common import fresh, small_batches, stored
from trolley.llm.components import components
from trolley.llm.textscan import column_bytes, groups, mix, runs, word_hashes

SHINGLE = 5
WIDTH = 3
RECALL = 0.998
FIRST = 3  # rounds in which one class of a bucket leads
GROWTH = 64  # then about 64 do, then 4096, and so on
ODD = 1024  # bits of an odd sketch
SPREADS = 5  # standard deviations above the mean that its differing bits may reach
CHUNK = 256  # comparisons with one class that share a task's copy of its text


def table_chance(m, similarity):
    """Probability that a pair shares a key in both collections, so a table key."""
    return (1 - (1 - similarity**WIDTH) ** m) ** 2


def collection_size(percent):
    """The fewest keys per collection that leave a quarter of the allowed misses to the sketch."""
    return next(m for m in itertools.count(2) if 1 - table_chance(m, percent / 100) <= 0.75 * (1 - RECALL))


def agreement(m, percent):
    """Minhashes of the 2 * m * WIDTH that a pair must share; misses the rest of the allowed."""
    n, s = 2 * m * WIDTH, percent / 100
    below, least = 0.0, 0
    while below + math.comb(n, least) * s**least * (1 - s) ** (n - least) <= 0.25 * (1 - RECALL):
        below += math.comb(n, least) * s**least * (1 - s) ** (n - least)
        least += 1
    return least


def odd_sketches(owners, hashes, n):
    """For each of ``n`` sets a row of longs: the parity of its hashes in each of ``ODD`` places.

    The bits in which two sketches differ are those of the sets' symmetric difference,
    so never more than its size.
    """
    places, rows = (mix(hashes ^ np.uint64(0x3C3C3C3C)) % np.uint64(ODD)).astype(np.int64), []
    for start in range(0, n, 512):
        end = min(start + 512, n)
        a, b = np.searchsorted(owners, [start, end])
        counts = np.bincount((owners[a:b] - start) * ODD + places[a:b], minlength=(end - start) * ODD)
        rows.append(np.packbits((counts & 1).astype(np.uint8).reshape(-1, ODD), axis=1).view(np.int64))
    return np.concatenate(rows) if rows else np.zeros((0, ODD // 64), np.int64)


def odd_limit(total, percent):
    """How many bits the odd sketches of two similar sets of ``total`` shingles together differ in at most.

    Sets at the limit differ in d shingles. These flip no more than d bits, and beyond
    ``SPREADS`` standard deviations above the mean only one in a million times.
    """
    d = F.floor(total * F.lit(100 - percent) / F.lit(100 + percent))
    once, twice = F.pow(F.lit(1 - 2 / ODD), d), F.pow(F.lit(1 - 4 / ODD), d)
    mean = ODD / 2 * (1 - once)
    variance = ODD / 4 * (1 - twice) + ODD**2 / 4 * (twice - once * once)
    return F.least(d.cast("double"), mean + SPREADS * F.sqrt(F.greatest(variance, F.lit(1.0))))


def shingle_sets(texts):
    """Sorted distinct shingle hashes of each text."""
    sets = []
    for start, end in groups(texts):
        owners, hashes = word_hashes([t.lower() for t in texts[start:end]])
        at, shingles = runs(owners, hashes, SHINGLE)
        n = end - start
        bounds = np.searchsorted(owners[at], np.arange(n + 1))
        words = np.searchsorted(owners, np.arange(n + 1))
        for i in range(n):
            own = shingles[bounds[i] : bounds[i + 1]]
            size = words[i + 1] - words[i]
            if 0 < size < SHINGLE:
                own = runs(np.zeros(size, int), hashes[words[i] : words[i + 1]], int(size))[1]
            sets.append(np.unique(own))
    return sets


def _signatures(m):
    seeds = mix(np.arange(1, 4 * m * WIDTH + 1, dtype=np.uint64))
    factors, shifts = seeds[: 2 * m * WIDTH] | np.uint64(1), seeds[2 * m * WIDTH :]

    def run(batches):
        for batch in batches:
            texts = column_bytes(batch, "text")
            sizes, sums, keys, sketches, odds = [], [], [], [], []
            for start, end in groups(texts):
                sets = shingle_sets(texts[start:end])
                size = np.array([len(s) for s in sets])
                full = np.flatnonzero(size)
                sizes.append(size)
                total = np.zeros((end - start, 2), np.uint64)
                key = np.zeros((end - start, 2 * m), np.uint64)
                sketch = np.zeros((end - start, 2 * m * WIDTH), np.int8)
                odds.append(odd_sketches(np.repeat(np.arange(end - start), size), np.concatenate(sets), end - start))
                if len(full):
                    flat = np.concatenate([sets[i] for i in full])
                    at = np.concatenate(([0], np.cumsum(size[full])[:-1]))
                    total[full, 0] = np.add.reduceat(mix(flat), at)
                    total[full, 1] = np.add.reduceat(mix(flat ^ np.uint64(0xA5A5A5A5)), at)
                    for k in range(2 * m):
                        joint = np.zeros(len(full), np.uint64)
                        for j in range(k * WIDTH, (k + 1) * WIDTH):
                            least = np.minimum.reduceat(flat * factors[j] + shifts[j], at)
                            sketch[full, j] = (mix(least) >> np.uint64(57)).astype(np.int8)
                            joint = mix(joint ^ least)
                        key[full, k] = joint
                sums.append(total)
                keys.append(key)
                sketches.append(sketch)
            if not sizes:
                continue
            size, total, key = np.concatenate(sizes), np.concatenate(sums).view(np.int64), np.concatenate(keys).view(np.int64)

            def lists(part):
                flat = pa.array(np.ascontiguousarray(part).ravel())
                return pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1, dtype=np.int32) * part.shape[1]), flat)

            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size), pa.array(total[:, 0].copy()), pa.array(total[:, 1].copy()),
                 lists(key[:, :m]), lists(key[:, m:]), lists(np.concatenate(sketches)), lists(np.concatenate(odds)), batch.column(1)],
                names=["doc_id", "n_shingles", "sum_1", "sum_2", "left_keys", "right_keys", "sketch", "odd", "text"],
            )

    return run


def signatures(docs, m):
    """Per row: set size, a digest of the whole set, the two key collections, bits of all minhashes, the odd sketch, and the text."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    schema = "doc_id long, n_shingles long, sum_1 long, sum_2 long, left_keys array<long>, " \
        "right_keys array<long>, sketch array<byte>, odd array<long>, text string"
    return rows.mapInArrow(_signatures(m), schema)


def _similar(percent):
    def run(batches):
        lead, lead_set = None, None
        for batch in batches:
            texts = column_bytes(batch, "text")
            a, b, first = (batch.column(k).to_pylist() for k in range(3))
            links, at = [], 0
            while at < len(texts):
                # Sets are made for a megabyte of texts at a time.
                upto = at + next(groups(texts[at:]))[1]
                for i, own in enumerate(shingle_sets(texts[at:upto]), at):
                    if first[i]:
                        lead, lead_set = a[i], own
                        continue
                    if a[i] != lead or 100 * min(len(own), len(lead_set)) < percent * max(len(own), len(lead_set)):
                        continue
                    both = len(np.intersect1d(own, lead_set, assume_unique=True))
                    if both and 100 * both >= percent * (len(own) + len(lead_set) - both):
                        links.append((a[i], b[i]))
                at = upto
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links)], names=["a", "b"])

    return run


def similar_pairs(texts, pairs, percent):
    """Those of the pairs (a, b) whose full sets are similar enough.

    ``texts`` has b and text. The text of ``a`` goes once to every chunk of its
    partners, and a task reads a chunk in order, holding one set.
    """
    sizes = pairs.groupBy("a").agg(F.ceil(F.count("*") / CHUNK).alias("chunks"))
    chunk = F.pmod(F.xxhash64("b"), F.col("chunks")).cast("int")
    members = stored(pairs.join(sizes, "a").select("a", "b", chunk.alias("chunk")), "dup_members")
    leads = members.select("a", "chunk").distinct().select("a", F.col("a").alias("b"), "chunk")
    sides = members.withColumn("first", F.lit(False)).unionByName(leads.withColumn("first", F.lit(True)))
    rows = sides.join(texts, "b").withColumn("place", F.xxhash64("a", "chunk"))
    spread = rows.repartition("place").sortWithinPartitions("place", "a", "chunk", F.desc("first"))
    return spread.select("a", "b", "first", "text").mapInArrow(_similar(percent), "a long, b long")


def near_duplicates(docs, percent=80):
    """doc_id, n_shingles, component_id and kept for every row.

    Linked are documents whose sets have 100 * intersection >= percent * union.
    """
    small_batches(docs.sparkSession)
    m = collection_size(percent)
    signed = stored(signatures(docs, m).withColumn("row", F.monotonically_increasing_id()), "dup_signatures")
    usable = signed.filter("n_shingles > 0 and doc_id is not null")
    # A class is a digest of a whole set; one of its rows, by number, is its node.
    same = ["n_shingles", "sum_1", "sum_2"]
    classes = stored(usable.groupBy(*same).agg(F.min("doc_id").alias("rep"), F.min("row").alias("node")), "dup_classes")
    labels = _labels(signed, classes.select("node"), m, percent)
    found = classes.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = found.groupBy("component").agg(F.min("rep").alias("component_id"))
    own = stored(found.join(smallest, "component").select(*same, "component_id"), "dup_components")
    own = own.select(*[F.col(c).alias(f"own_{c}") for c in same], "component_id")
    matched = (signed["n_shingles"] > 0) & signed["doc_id"].isNotNull()
    for c in same:
        matched &= signed[c] == own[f"own_{c}"]
    component = F.coalesce("component_id", "doc_id")
    return signed.select("doc_id", *same).join(own, matched, "left").select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def _buckets(signed, classes, m):
    """key, place, node and n of all table keys that several nodes share; and the nodes with sketches, keys, size and mates.

    ``mates`` counts the other nodes of all buckets of a node.
    """
    nodes = stored(
        signed.select(F.col("row").alias("node"), "n_shingles", "sketch", "odd", "left_keys", "right_keys").join(classes, "node"),
        "dup_nodes",
    )
    table_keys = F.array(*[
        F.xxhash64(F.lit(i * m + j), F.col("left_keys")[i], F.col("right_keys")[j]) for i in range(m) for j in range(m)
    ])
    buckets = nodes.select("node", F.posexplode(table_keys).alias("place", "key"))
    shared = stored(buckets.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "dup_keys")
    members = stored(buckets.join(shared, "key"), "dup_buckets")
    mates = members.groupBy("node").agg(F.sum("n").alias("mates"))
    # Of the keys, 32 bits do to tell which two nodes share.
    short = [F.transform(side, lambda key: F.hash(key)).alias(side) for side in ("left_keys", "right_keys")]
    return members, stored(mates.join(nodes.select("node", "n_shingles", "sketch", "odd", *short), "node"), "dup_mates")


def _first_common(left, right):
    """The first place at which two lists agree."""
    return F.array_position(F.zip_with(left, right, lambda x, y: x == y), F.lit(True)) - 1


def _labels(signed, classes, m, percent):
    """node and component of every node that is linked."""
    members, nodes = _buckets(signed, classes, m)
    texts = stored(
        signed.select(F.col("row").alias("b"), "text").join(nodes.select(F.col("node").alias("b")), "b"), "dup_texts"
    )
    sides = nodes.select("node", "n_shingles", "sketch", "odd")
    told = ["n_shingles", "odd", "left_keys", "right_keys"]
    lead_side = sides.select(*[F.col(c).alias(f"lead_{c}") for c in sides.columns])
    agree = F.size(F.filter(F.zip_with("sketch", "lead_sketch", lambda x, y: x == y), lambda x: x)) >= agreement(m, percent)
    bits = F.zip_with("odd", "lead_odd", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    differ = F.aggregate(bits, F.lit(0), lambda total, x: total + x)
    near = differ <= odd_limit(F.col("n_shingles") + F.col("lead_n_shingles"), percent)
    small, large = F.least("n_shingles", "lead_n_shingles"), F.greatest("n_shingles", "lead_n_shingles")
    found = labels = tested = None
    turn = 0
    while True:
        labelled = members.withColumn("component", F.col("node")) if labels is None else members.join(
            labels, "node", "left"
        ).withColumn("component", F.coalesce("component", "node"))
        labelled = stored(labelled.join(nodes.select("node", "mates"), "node"), "dup_labelled")
        apart = labelled.groupBy("key").agg(
            F.min("component").alias("lo"), F.max("component").alias("hi"), F.max_by("node", "mates").alias("first"),
            F.count("*").alias("left"),
        )
        apart = stored(apart.filter("lo < hi").select("key", "first", "left"), "dup_apart")
        rest = stored(labelled.join(apart, "key").select("key", "place", "node", "component", "first", "left"), "dup_rest")
        if rest.isEmpty():
            return labels if labels is not None else members.select("node", F.col("node").alias("component")).limit(0)
        # At first one node of a bucket leads, then about GROWTH, GROWTH^2 ... of them, chosen by hash.
        width = F.lit(float(GROWTH ** max(turn - FIRST + 1, 0)))
        drawn = F.pmod(F.xxhash64("node", F.lit(turn)), F.greatest(F.ceil(F.col("left") / width), F.lit(1))) == 0
        leads = F.col("node") == F.col("first")
        rest = rest.withColumn("leads", leads if turn < FIRST else leads | drawn)
        wanted = F.col("component") != F.col("lead_component")
        # A pair of two leads is met from one side only.
        wanted &= ~F.col("leads") | (F.col("node") > F.col("lead_node"))
        listed, columns = rest, ["node", "component"]
        if turn >= FIRST:
            # Similar nodes share many buckets; where many lead, a pair is met in the first of them only,
            # and told apart on the spot if it can be.
            listed, columns = rest.join(nodes.select("node", *told), "node"), [*columns, *told]
            left, right = (_first_common(side, f"lead_{side}") for side in ("left_keys", "right_keys"))
            wanted &= (F.col("place") == left * m + right) & near
        lead = stored(
            listed.filter("leads").select("key", *[F.col(c).alias(f"lead_{c}") for c in columns]), "dup_leads"
        )
        pairs = listed.join(lead, "key").filter(wanted).select("node", "lead_node").distinct()
        pairs = pairs.join(sides, "node").join(lead_side, "lead_node").filter((100 * small >= percent * large) & agree & near)
        pairs = pairs.select(F.col("lead_node").alias("a"), F.col("node").alias("b"))
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = stored(pairs, "dup_pairs")
        tested = pairs if tested is None else tested.unionByName(pairs)
        linked = stored(similar_pairs(texts, pairs, percent), "dup_links")
        found = linked if found is None else found.unionByName(linked)
        if labels is None or not linked.isEmpty():
            labels = components(found)
        members = rest.filter(~F.col("leads")).select("key", "place", "node")
        turn += 1


def drop_near_duplicates(docs, percent=80):
    """One document of each group of near-duplicates, the one with the smallest id."""
    kept = near_duplicates(docs, percent).groupBy("doc_id").agg(F.max("kept").alias("kept"))
    gone = kept.filter("not kept").select("doc_id")
    (name,) = fresh(docs, "dropped_id")
    gone = gone.withColumnRenamed("doc_id", name)
    return docs.join(gone, docs["doc_id"].cast("long") == gone[name], "left_anti")
