"""How far the sources of a language differ in the words they use.

A term is a run of bytes that are ASCII letters or not ASCII at all, with A-Z
lower-cased. One ``bytes.translate`` lowers the letters and blanks everything
else, ``bytes.split`` gives the terms, and a ``Counter`` per document their
frequencies; one packed number per term adds up occurrences and documents. A task
sends its sums on whenever it holds ``HELD`` of them, so its memory is bounded and
a hot source is pre-aggregated by every task that reads it.

Each language keeps the terms in at least ``least_docs`` of its documents. A
group (language and source) has a smoothed share of each kept term in billionths,

    p = 1 + floor(1000000000 * (count + 5) / (N + 5 * V)),

where N counts its occurrences of kept terms and V the kept terms. Two groups
differ by the sum of |p - q| over all kept terms, and a group stands out by the
terms with p above the language's q.

Counts stay sparse on the way: terms of a language are dealt to buckets of about
``BUCKET`` terms and its sources to tiles of about ``TILE``, and a task lays out
only one bucket for two tiles at a time, so neither the vocabulary nor the number
of sources has a bound. The sums over pairs are the result itself: as many rows
as a language has pairs of sources.

Edge cases: null text, language or source counts as ''. A group without terms
takes part with its shares 5 / (N + 5 * V) of nothing, a language without kept
terms has value 0 for all its pairs. A very long text is split piece by piece.
Repeated rows count as often as they occur, and documents are rows. Other columns
of the input are not read. An empty table gives an empty result. Arithmetic is in
64-bit integers, exact while N + 5 * V stays below 9 * 10^15.
"""

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trolley.llm.common import stored
from trolley.llm.textscan import column_bytes

PIECE = 1 << 20  # bytes of a text split at a time
HELD = 400_000  # sums a task holds
BUCKET = 4096
TILE = 256
SMOOTH = 5
SCALE_STEPS = 3  # three steps of a thousand: shares are in billionths
_DOC = 1 << 44  # documents are counted above the occurrences

# Bytes of terms: letters (lower-cased) and everything beyond ASCII; blanks for the rest.
_LETTERS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def term_counts(text):
    """Occurrences of each term of one text, given as bytes."""
    text = text.translate(_LETTERS)
    if len(text) <= PIECE:
        return Counter(text.split())
    found, at = Counter(), 0
    while at < len(text):
        end = len(text)
        if end - at > PIECE:
            end = text.rfind(b" ", at, at + PIECE)
            if end <= at:
                end = text.find(b" ", at + PIECE)
            end = len(text) if end < 0 else end
        found.update(text[at:end].split())
        at = end
    return found


def _count(batches):
    held, size = {}, 0

    def rows():
        lang, source, term, packed = [], [], [], []
        for (own_lang, own_source), sums in held.items():
            lang += [own_lang] * len(sums)
            source += [own_source] * len(sums)
            term += sums.keys()
            packed += sums.values()
        packed = np.array(packed, np.int64)
        text = lambda x: pa.array(x, pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays(
            [text(lang), text(source), text(term), pa.array(packed % _DOC), pa.array(packed // _DOC)],
            names=["lang", "source", "term", "n", "n_docs"],
        )

    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            for lang, source, text in zip(*(column_bytes(part, c) for c in ("lang", "source", "text"))):
                # The empty term stands for the group itself, so that none is lost.
                sums = held.setdefault((lang, source), {b"": 0})
                before, get = len(sums), sums.get
                for term, n in term_counts(text).items():
                    sums[term] = get(term, 0) + n + _DOC
                size += len(sums) - before
                if size >= HELD:
                    yield rows()
                    held, size = {}, 0
    if held:
        yield rows()


def group_counts(docs):
    """lang, source, term, n and n_docs; every group also has the empty term with n 0."""
    texts = docs.select(*[F.col(c).cast("string") for c in ("lang", "source", "text")])
    found = texts.mapInArrow(_count, "lang string, source string, term string, n long, n_docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))


def shares(counts, total, n_terms):
    """1 + floor(10^9 * (count + 5) / (total + 5 * n_terms)), digit by digit so that nothing overflows."""
    whole = total + SMOOTH * n_terms
    value, rest = np.divmod(counts + SMOOTH, whole)
    for _ in range(SCALE_STEPS):
        digits, rest = np.divmod(rest * 1000, whole)
        value = value * 1000 + digits
    return value + 1


def _parts(n, size):
    return F.ceil(n / F.lit(float(size))).cast("int")


def _tiled(cells, groups, langs):
    """Cells and group rows, once for every pair of tiles and bucket that needs them.

    A group row (term null) goes to every bucket, for the bucket must know the
    groups without any of its terms.
    """
    tile = F.pmod(F.xxhash64("source"), F.col("tiles")).cast("int")
    pairs = F.explode(F.transform(
        F.sequence(F.lit(0), F.col("tiles") - 1),
        lambda other: F.struct(F.least("tile", other).alias("tile_a"), F.greatest("tile", other).alias("tile_b")),
    ))
    meta = langs.select("lang", "n_terms", "lang_total", _parts(F.col("n_terms"), BUCKET).alias("buckets"),
                        _parts(F.col("n_sources"), TILE).alias("tiles"))
    bucket = F.pmod(F.xxhash64("term"), F.col("buckets")).cast("int")
    own = cells.join(meta, "lang").select(
        "lang", bucket.alias("bucket"), tile.alias("tile"), "tiles", "source", "term", "n", "total",
        F.lit(None).cast("long").alias("n_terms"),
    )
    every = F.explode(F.sequence(F.lit(0), F.col("buckets") - 1))
    heads = groups.join(meta.filter("n_terms > 0"), "lang").select(
        "lang", every.alias("bucket"), tile.alias("tile"), "tiles", "source", F.lit(None).cast("string").alias("term"),
        F.col("group_total").alias("n"), F.col("lang_total").alias("total"), "n_terms",
    )
    rows = heads.unionByName(own).withColumn("at", pairs)
    return rows.select("lang", "at.tile_a", "at.tile_b", "bucket", "tile", "source", "term", "n", "total", "n_terms")


_FOUND = "lang string, source string, part string, item string, value long"


def _compare(first):
    """Per (lang, tiles, bucket), in order: partial sums of pairs, and each group's ``first`` terms."""

    def found(key, rows):
        lang, tile_a, tile_b, _ = key
        heads = rows.slice(0, rows["term"].null_count)
        cells = rows.slice(len(heads))
        sources, tiles = heads["source"].to_pylist(), heads["tile"].to_numpy()
        places = {s: i for i, s in enumerate(sources)}
        totals, n_terms = heads["n"].to_numpy(), int(heads["n_terms"][0].as_py())
        lang_total = int(heads["total"][0].as_py())
        coded = cells["term"].combine_chunks().dictionary_encode()
        terms, at = coded.dictionary, coded.indices.to_numpy()
        own = np.array([places[s] for s in cells["source"].to_pylist()], np.int64)
        counts = np.zeros((len(sources), len(terms)), np.int64)
        counts[own, at] = cells["n"].to_numpy()
        p = shares(counts, totals[:, None], n_terms)
        out = []
        for i in range(len(sources)):
            others = np.flatnonzero(tiles == tile_b) if tiles[i] == tile_a else np.flatnonzero(tiles == tile_a)
            others = others[others != i]
            sums = np.abs(p[others] - p[i]).sum(axis=1)
            out += [(sources[i], "pair", sources[j], v) for j, v in zip(others.tolist(), sums.tolist())]
        if tile_a == tile_b:
            total = np.zeros(len(terms), np.int64)
            total[at] = cells["total"].to_numpy()
            over = p - shares(total, lang_total, n_terms)
            order = np.argsort(np.array(terms.cast(pa.binary()).to_pylist() + [None], object)[:-1])
            names = terms.to_pylist()
            for i in range(len(sources)):
                own = order[(counts[i, order] > 0) & (over[i, order] > 0)]
                best = own[np.argsort(-over[i, own], kind="stable")[:first]]
                out += [(sources[i], "term", names[j], int(over[i, j])) for j in best.tolist()]
        if out:
            source, part, item, value = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(out)), pa.array(source), pa.array(part), pa.array(item), pa.array(value, pa.int64())],
                names=["lang", "source", "part", "item", "value"],
            )

    def run(batches):
        key, held = None, []
        for batch in batches:
            marks = list(zip(*(batch.column(k).to_pylist() for k in range(4))))
            start = 0
            for end in range(1, len(marks) + 1):
                if end < len(marks) and marks[end] == marks[start]:
                    continue
                if marks[start] != key:
                    if held:
                        yield from found(key, pa.Table.from_batches(held))
                    key, held = marks[start], []
                held.append(batch.slice(start, end - start))
                start = end
        if held:
            yield from found(key, pa.Table.from_batches(held))

    return run


def source_divergence(docs, least_docs=30, first=50):
    """lang, source, part, item, value and rank.

    Part 'pair' has every other source of the language by how far it is away; part
    'term' the ``first`` terms by which a source stands out from its language.
    Ranks go by value, highest first, then by item.
    """
    counted = stored(group_counts(docs), "audit_counts")
    kept = stored(
        counted.filter("term != ''").groupBy("lang", "term")
        .agg(F.sum("n").alias("total"), F.sum("n_docs").alias("n_docs"))
        .filter(F.col("n_docs") >= least_docs).drop("n_docs"),
        "audit_terms",
    )
    cells = stored(counted.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "total"), "audit_cells")
    known = counted.filter("term = ''").select("lang", "source")
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("group_total"))
    groups = stored(known.join(totals, ["lang", "source"], "left").fillna(0, ["group_total"]), "audit_groups")
    sizes = kept.groupBy("lang").agg(F.count("*").alias("n_terms"))
    langs = stored(
        groups.groupBy("lang").agg(F.count("*").alias("n_sources"), F.sum("group_total").alias("lang_total"))
        .join(sizes, "lang", "left").fillna(0, ["n_terms"]),
        "audit_langs",
    )
    tiled = _tiled(cells, groups, langs).repartition("lang", "tile_a", "tile_b", "bucket")
    ordered = tiled.sortWithinPartitions("lang", "tile_a", "tile_b", "bucket", F.col("term").asc_nulls_first())
    partial = ordered.mapInArrow(_compare(first), _FOUND)
    # A language without kept terms has pairs, too.
    bare = groups.join(langs.filter("n_terms = 0").select("lang"), "lang").select("lang", "source")
    bare = bare.join(bare.select("lang", F.col("source").alias("item")), "lang").filter("source != item")
    bare = bare.select("lang", "source", F.lit("pair").alias("part"), "item", F.lit(0).cast("long").alias("value"))
    summed = partial.unionByName(bare).groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    place = F.row_number().over(W.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    return summed.withColumn("rank", place).filter((F.col("part") == "pair") | (F.col("rank") <= first))
