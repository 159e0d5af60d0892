"""Sampled SentencePiece segmentations that decode to the text again.

A text, with a space in front and every space written as the piece mark, spans a
lattice: an edge for every vocabulary piece that occurs, and for characters without a
piece one edge with their UTF-8 byte pieces. An edge's log probability falls with
the logarithm of its piece's rank. Forward filtering sums the probabilities of all
ways to each place; backward sampling then draws edges from the end. The draws come
from a keyed digest of row key, seed, place and step, so a row gets the same pieces
wherever and however often it is encoded.

No piece crosses the start of a run of spaces, or the border of Latin letters and
ASCII signs (checked when a model is loaded), so the lattice falls apart there
into short units; filtering is done once per distinct unit and sampling for all
units of many texts at once. This is the same distribution as that of the whole
lattice.

Edge cases: null texts give null pieces, empty ones an empty list; equal texts
under different keys may differ, repeated rows do not; a null key counts as a key
of its own; the piece mark itself, and any other character without a piece, is
written in bytes, so decoding is lossless for every text. Other columns are kept by
``encode``, whatever their names.
"""

import itertools
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trolley.llm.textscan import groups, mix

MARK = "▁"
CACHED_UNITS = 120_000
GROUP = 1 << 20  # characters sampled together
_LATIN, _SIGN = r"A-Za-zÀ-ÖØ-öø-ɏ", r"\x00-\x1f!-@\[-`{-\x7f"
_UNITS = re.compile(rf" *[{_LATIN}]+(?=[{_SIGN} ]|\Z)| *[{_SIGN}]+(?=[{_LATIN} ]|\Z)| *[^ ]+| +", re.S)
_SPACED = re.compile(r" *[^ ]+| +", re.S)
_CROSSING = re.compile(rf"[{_LATIN}][{_SIGN}]|[{_SIGN}][{_LATIN}]")
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)

_models = {}


class Model:
    """Pieces of a SentencePiece model, their weights, and the units met so far."""

    def __init__(self, path, alpha):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.text, self.bytes = {}, {}
        self.plain = [b""] * n  # what a piece decodes to
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.plain[i] = bytes([int(piece[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.text[piece.replace(MARK, " ")] = i
                self.plain[i] = piece.replace(MARK, " ").encode()
        if len(self.bytes) < 256:
            raise ValueError("the model needs byte pieces for lossless decoding")
        if any(re.search("[^ ] ", p) for p in self.text):
            raise ValueError("a piece of the model goes across the start of a run of spaces")
        self.cut = _SPACED if any(_CROSSING.search(p) for p in self.text) else _UNITS
        # Rank by score, best first; the byte pieces come after all others.
        order = sorted(self.text.values(), key=lambda i: -model.get_score(i))
        self.weight = np.full(n, -alpha * np.log(len(order) + 2.0))
        self.weight[order] = -alpha * np.log(np.arange(2, len(order) + 2))
        self.spelled = []  # byte pieces of a character; edge_piece -1 - k is the k-th
        self.spelled_at = {}
        self._index()
        self._clear()

    def _index(self):
        """Hashes of all beginnings of the pieces by length, and the piece that each is, or -1."""
        self.longest = max(map(len, self.text))
        begins = [{} for _ in range(self.longest + 1)]
        for piece, i in self.text.items():
            h = 0
            for k, c in enumerate(piece, 1):
                h = (h * int(_BASE) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
                begins[k].setdefault(h, -1)
            begins[len(piece)][h] = i
        self.begins = [np.array(sorted(b), np.uint64) for b in begins]
        self.ids = [np.array([b[h] for h in sorted(b)], np.int64) for b in begins]

    def _clear(self):
        self.units = {}  # unit -> its number
        self.last = np.zeros(0, np.int64)  # node at the end of each unit
        self.first = np.zeros(0, np.int64)  # the first edge of each node
        self.reach = np.zeros(0)  # cumulative probability of its edges
        self.edge_from, self.edge_piece = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.nodes = 0

    def _edges(self, codes, starts, ends):
        """(from, to, piece, log weight) of all edges of units in one array of characters."""
        place = np.arange(len(codes))
        stop = np.repeat(ends, ends - starts)
        h, found, covered = np.zeros(len(codes), np.uint64), [], np.zeros(len(codes), bool)
        for length in range(1, self.longest + 1):
            keep = place + length <= stop[place]
            place, h = place[keep], h[keep]
            h = h * _BASE + codes[place + length - 1] + np.uint64(1)
            begins = self.begins[length]
            at = np.minimum(np.searchsorted(begins, h), len(begins) - 1)
            keep = np.flatnonzero(begins[at] == h)
            if not len(keep):
                break
            place, h, piece = place[keep], h[keep], self.ids[length][at[keep]]
            hit = np.flatnonzero(piece >= 0)
            if len(hit):
                left, piece = place[hit], piece[hit]
                found.append((left, left + length, piece, self.weight[piece]))
                if length == 1:
                    covered[left] = True
        bare = np.flatnonzero(~covered)
        if len(bare):
            kinds, of = np.unique(codes[bare], return_inverse=True)
            number, weight = [], []
            for code in kinds.tolist():
                if code not in self.spelled_at:
                    self.spelled_at[code] = len(self.spelled)
                    self.spelled.append([self.bytes[b] for b in chr(code).encode("utf-8", "surrogatepass")])
                number.append(-1 - self.spelled_at[code])
                weight.append(self.weight[self.spelled[self.spelled_at[code]]].sum())
            found.append((bare, bare + 1, np.array(number)[of], np.array(weight)[of]))
        return [np.concatenate(c) for c in zip(*found)]

    def learn(self, units):
        """Filter the lattices of units not met before."""
        text = "".join(units)
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        sizes = np.array([len(u) for u in units])
        ends = np.cumsum(sizes)
        starts = ends - sizes
        left, right, piece, weight = self._edges(codes, starts, ends)
        # Nodes are the places after each character, numbered by depth in their unit first.
        depth = np.arange(len(codes)) - np.repeat(starts, sizes)
        order = np.argsort(depth, kind="stable")
        number = np.empty(len(codes), np.int64)
        number[order] = np.arange(len(codes))
        to = number[right - 1]
        inner = depth[np.minimum(left, len(codes) - 1)] > 0
        before = np.where(inner, number[left - 1], -1)
        by_node = np.argsort(to, kind="stable")
        to, before, piece, weight = to[by_node], before[by_node], piece[by_node], weight[by_node]
        first = np.searchsorted(to, np.arange(len(codes) + 1))
        bounds = np.searchsorted(depth[order], np.arange(depth.max() + 2)) if len(codes) else np.zeros(1, int)
        alpha, share = np.zeros(len(codes) + 1), np.zeros(len(to))  # the last place stands for a unit's start
        for lo, hi in zip(bounds[:-1], bounds[1:]):
            a, b = first[lo], first[hi]
            value = alpha[before[a:b]] + weight[a:b]
            cuts = first[lo:hi] - a
            counts = np.diff(np.append(cuts, b - a))
            top = np.maximum.reduceat(value, cuts)
            value = np.exp(value - np.repeat(top, counts))
            total = np.add.reduceat(value, cuts)
            alpha[lo:hi] = top + np.log(total)
            share[a:b] = value / np.repeat(total, counts)
        reach = np.cumsum(share)
        reach = reach - np.repeat(np.concatenate(([0.0], reach))[first[:-1]], np.diff(first))
        reach[first[1:] - 1] = 1.0
        self.units.update(zip(units, range(len(self.last), len(self.last) + len(units))))
        self.last = np.concatenate((self.last, number[ends - 1] + self.nodes))
        self.first = np.concatenate((self.first, first[:-1] + len(self.reach)))
        self.reach = np.concatenate((self.reach, np.minimum(reach, 1.0)))
        self.edge_from = np.concatenate((self.edge_from, np.where(before >= 0, before + self.nodes, -1)))
        self.edge_piece = np.concatenate((self.edge_piece, piece))
        self.nodes += len(codes)

    def sample(self, texts, keys):
        """Piece ids of every text, drawn by its key (unsigned 64-bit)."""
        split = [self.cut.findall(" " + t) if t else [] for t in texts]
        sizes = np.array([len(s) for s in split])
        flat = list(itertools.chain.from_iterable(split))
        if not flat:
            return [np.zeros(0, np.int64) for _ in texts]
        within = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        base = mix(np.repeat(keys, sizes) + within.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        # More distinct units than the cache holds are sampled in runs, each with no more.
        run = len(flat) if len(flat) <= CACHED_UNITS or len(set(flat)) <= CACHED_UNITS else CACHED_UNITS
        done = [self._draw(flat[k : k + run], base[k : k + run]) for k in range(0, len(flat), run)]
        pieces, count = (np.concatenate(c) for c in zip(*done))
        bounds = np.concatenate(([0], np.cumsum(count)))[np.concatenate(([0], np.cumsum(sizes)))]
        pieces, bounds = self._spell(pieces, bounds)
        return [pieces[a:b] for a, b in zip(bounds[:-1], bounds[1:])]

    def _draw(self, flat, base):
        """Pieces of the units of a list, and their number for each; ``base`` has the units' draws."""
        wanted = set(flat)
        new = wanted.difference(self.units)
        if len(self.units) + len(new) > CACHED_UNITS:
            self._clear()
            new = wanted
        if new:
            self.learn(list(new))
        units = self.units
        which = np.fromiter(map(units.__getitem__, flat), np.int64, len(flat))
        node, active, steps = self.last[which], np.arange(len(which)), []
        step = 0
        while len(active):
            draw = (mix(base[active] + np.uint64(step)) >> np.uint64(12)).astype(np.float64) * 2.0**-52
            # A node has few edges, and the last one reaches 1.
            edge = self.first[node]
            short = np.flatnonzero(self.reach[edge] <= draw)
            while len(short):
                edge[short] += 1
                short = short[self.reach[edge[short]] <= draw[short]]
            steps.append((active, self.edge_piece[edge]))
            node = self.edge_from[edge]
            active, node = active[node >= 0], node[node >= 0]
            step += 1
        # The draws went backwards: a unit's pieces are in falling order of their step.
        count = np.zeros(len(which), np.int64)
        for at, _ in steps:
            count[at] += 1
        after = np.cumsum(count)
        pieces = np.empty(after[-1], np.int64)
        for k, (at, piece) in enumerate(steps):
            pieces[after[at] - 1 - k] = piece
        return pieces, count

    def _spell(self, pieces, bounds):
        """The pieces with byte pieces for characters that have none, and where the bounds come to lie."""
        bare = np.flatnonzero(pieces < 0)
        if not len(bare):
            return pieces, bounds
        lengths = np.array([len(s) for s in self.spelled])
        which = -1 - pieces[bare]
        sizes = np.ones(len(pieces), np.int64)
        sizes[bare] = lengths[which]
        after = np.concatenate(([0], np.cumsum(sizes)))
        done, own = np.repeat(pieces, sizes), lengths[which]
        within = np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
        spelled = np.array(list(itertools.chain.from_iterable(self.spelled)), np.int64)
        done[np.repeat(after[bare], own) + within] = spelled[np.repeat((np.cumsum(lengths) - lengths)[which], own) + within]
        return done, after[bounds]

    def decode(self, pieces):
        """The text of piece ids."""
        plain = self.plain
        return b"".join([plain[i] for i in pieces.tolist()])[1:].decode("utf-8", "surrogatepass")


def model(path, alpha):
    """The model of this worker."""
    if (path, alpha) not in _models:
        _models[path, alpha] = Model(path, alpha)
    return _models[path, alpha]


def row_keys(ids, seed):
    """Unsigned keys of a pandas column of ids."""
    raw = [0 if i is None else (int(i) * 2 + 1) & 0xFFFFFFFFFFFFFFFF for i in ids]
    return mix(np.array(raw, np.uint64) ^ mix(np.array([seed], np.uint64)))


def _each(batches, path, alpha, seed, make):
    """Each batch with ``make`` of every text and its pieces; the last two columns are id and text."""
    for batch in batches:
        texts = batch.column(batch.num_columns - 1).to_pylist()
        keys = row_keys(batch.column(batch.num_columns - 2).to_pylist(), seed)
        coder, out = model(path, alpha), []
        for start, end in groups([t or "" for t in texts], GROUP):
            part = texts[start:end]
            found = coder.sample([t or "" for t in part], keys[start:end])
            out += [make(coder, t, p) for t, p in zip(part, found)]
        if out:
            yield batch, out


def encode(docs, path, alpha=1.0, seed=13, key="doc_id", column="text", pieces="pieces"):
    """``docs`` with the sampled piece ids of the column; a column called ``pieces`` is replaced."""
    rest = docs.drop(pieces)
    names = rest.columns
    at_key, at_text = names.index(key), names.index(column)
    schema = T.StructType([*rest.schema.fields, T.StructField(pieces, T.ArrayType(T.IntegerType()))])

    def run(batches):
        for batch in batches:
            texts = batch.column(at_text).to_pylist()
            keys = row_keys(batch.column(at_key).to_pylist(), seed)
            for start, end in groups([t or "" for t in texts], GROUP):
                part = texts[start:end]
                found = model(path, alpha).sample([t or "" for t in part], keys[start:end])
                ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(
                    pa.array(ends), pa.array(np.concatenate(found).astype(np.int32)),
                    mask=pa.array([t is None for t in part]),
                )
                columns = batch.slice(start, end - start).columns
                yield pa.RecordBatch.from_arrays([*columns, lists], names=[*names, pieces])

    return rest.mapInArrow(run, schema)


def decode(rows, path, alpha=1.0, pieces="pieces", column="text"):
    """``rows`` with the text of their piece ids."""
    @F.pandas_udf(T.StringType())
    def joined(found: pd.Series) -> pd.Series:
        coder = model(path, alpha)
        return pd.Series([None if p is None else coder.decode(np.asarray(p)) for p in found])

    return rows.withColumn(column, joined(F.col(pieces)))


def round_trips(docs, path, alpha=1.0, seed=13):
    """doc_id, n_pieces, pieces_crc32 and whether decoding gives the text back, for every row.

    Null texts have no pieces and count as given back. The checksum is over the
    ids as little-endian 32-bit integers.
    """
    def row(coder, text, found):
        same = text is None or coder.decode(found) == text
        return len(found), zlib.crc32(found.astype("<u4").tobytes()), same

    def run(batches):
        for rows, made in _each(batches, path, alpha, seed, row):
            n, crc, same = (list(c) for c in zip(*made))
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(n, pa.int64()), pa.array(crc, pa.int64()), pa.array(same, pa.bool_())],
                names=["doc_id", "n_pieces", "pieces_crc32", "lossless"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, n_pieces long, pieces_crc32 long, lossless boolean")
