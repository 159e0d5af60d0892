"""Periodic runs of words: stretches that repeat themselves at least twice.

A run is a stretch of consecutive words with smallest period q, at least
``max(least, 2 * q)`` words long, that no neighbouring word extends keeping the
period. Such a run holds a place i of the grid 0, q, 2q, ... where word i equals
word i + q and several words before or after do, too; only these places are
candidates. How far each reaches is asked of a run-length grammar made by
recompression: rounds of block compression (equal neighbours become one symbol)
and pair compression (symbols fall into a left and a right class by a hash, and
every left-right pair of neighbours becomes one symbol) parse equal stretches
equally but for a symbol at either end. So two places climb the levels together,
comparing at most one symbol a level, until they differ, and come down comparing
at most one a level: an exact extension in logarithmic time, without suffix
arrays. All queries of a group of texts take each step together.

Periods are met in ascending order, and candidates inside a run already found
whose period divides theirs are left out, for they give that run again. Texts are
taken in groups of about a megabyte, or one longer text; n words take n log n
time, whatever they are.

Edge cases: a text that is null, empty or only white space has no words and no
runs, and collapses to the empty string. Words are compared as bytes. Equal rows
give equal results. All columns of the input are kept, whatever their names;
result columns take underscores in front where a name is taken. An empty table
gives an empty result.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trolley.llm.common import fresh
from trolley.llm.textscan import column_bytes, groups, mix

LEAST = 12
PLACES = 1 << 20  # grid places laid out together
CLASS = 4  # periods up to so many times the smallest are searched together


class Level:
    """Symbols of one level and how its boundaries map to the level above.

    Boundary b lies before symbol b. ``up`` has its number above, -1 inside a
    joined symbol; ``down`` leads back. On block levels, ``right`` and ``left``
    count the equal symbols on either side up to the end of their block.
    """

    def __init__(self, symbols, starts, blocks):
        n = len(symbols)
        self.symbols = symbols
        self.down = np.append(starts, n)
        self.up = np.full(n + 1, -1)
        self.up[self.down] = np.arange(len(self.down))
        self.right = self.left = None
        if blocks:
            lengths = np.diff(self.down)
            at = np.arange(n)
            self.right = np.append(np.repeat(self.down[1:], lengths) - at, 0)
            self.left = np.append(0, at + 1 - np.repeat(starts, lengths))

    def common(self, a, b, forward):
        """Symbols by which boundaries a and b can move on: 0 where they differ."""
        shift = 0 if forward else -1
        same = (self.symbols[a + shift] == self.symbols[b + shift]).astype(np.int64)
        if self.right is None:
            return same
        side = self.right if forward else self.left
        return same * np.minimum(side[a], side[b])


class Grammar:
    """Recompression of a sequence; ``walls`` marks symbols that differ from all others."""

    def __init__(self, symbols, walls):
        self.levels, self.symbols, self.walls = [], symbols.astype(np.int64), walls
        self.names = int(symbols.max(initial=0)) + 1
        ends, seed = 2 * int(walls.sum()), 0
        while len(self.symbols) > ends and seed < 100:
            self._join_blocks()
            self._join_pairs(seed)
            seed += 1

    def _push(self, starts, named, blocks):
        self.levels.append(Level(self.symbols, starts, blocks))
        self.symbols, self.walls = named, self.walls[starts]

    def _new_names(self, keys):
        kinds, which = np.unique(keys, return_inverse=True)
        first, self.names = self.names, self.names + len(kinds)
        return first + which

    def _join_blocks(self):
        starts = np.flatnonzero(np.append(True, self.symbols[1:] != self.symbols[:-1]))
        lengths = np.diff(np.append(starts, len(self.symbols)))
        named = self.symbols[starts]
        long = np.flatnonzero(lengths > 1)
        if len(long):
            named[long] = self._new_names(named[long] * (len(self.symbols) + 1) + lengths[long])
            self._push(starts, named, True)

    def _join_pairs(self, seed):
        bit = (mix(self.symbols.astype(np.uint64) ^ np.uint64((seed + 1) << 40)) & np.uint64(1)).astype(bool)
        ones, zeros = bit & ~self.walls, ~bit & ~self.walls
        firsts = [np.flatnonzero(x[:-1] & y[1:]) for x, y in ((ones, zeros), (zeros, ones))]
        first = max(firsts, key=len)
        if not len(first):
            return
        keep = np.ones(len(self.symbols), bool)
        keep[first + 1] = False
        starts = np.flatnonzero(keep)
        named = self.symbols.copy()
        named[first] = self._new_names(self.symbols[first] * self.names + self.symbols[first + 1])
        self._push(starts, named[starts], False)

    def extensions(self, a, b, forward):
        """For boundaries a != b of the sequence, how many symbols after (or before) them agree."""
        sign, origin = (1 if forward else -1), a
        a, b = a.copy(), b.copy()
        stop = np.full(len(a), len(self.levels))
        going = np.arange(len(a))
        for k, level in enumerate(self.levels):
            x, y = a[going], b[going]
            inside = np.flatnonzero((level.up[x] < 0) | (level.up[y] < 0))
            move = sign * level.common(x[inside], y[inside], forward)
            x[inside] += move
            y[inside] += move
            a[going], b[going] = x, y
            above_x, above_y = level.up[x], level.up[y]
            climbs = (above_x >= 0) & (above_y >= 0)
            stop[going[~climbs]] = k
            going = going[climbs]
            a[going], b[going] = above_x[climbs], above_y[climbs]
        shift = 0 if forward else -1
        while len(going):
            going = going[self.symbols[a[going] + shift] == self.symbols[b[going] + shift]]
            a[going] += sign
            b[going] += sign
        for k in range(len(self.levels) - 1, -1, -1):
            level = self.levels[k]
            coming = np.flatnonzero(stop > k)
            x, y = level.down[a[coming]], level.down[b[coming]]
            move = sign * level.common(x, y, forward)
            a[coming], b[coming] = x + move, y + move
        return np.abs(a - origin)


def _grid(starts, sizes, low, high):
    """Places i and periods q of the grids of all texts for periods from low to below high."""
    periods = np.maximum(np.minimum(high, sizes // 2 + 1) - low, 0)
    owner = np.repeat(np.arange(len(sizes)), periods)
    q = low + np.arange(len(owner)) - np.repeat(np.cumsum(periods) - periods, periods)
    counts = (sizes[owner] - 1) // np.maximum(q, 1)
    upto = np.cumsum(counts)
    at = 0
    while at < len(owner):
        done = upto[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(upto, done + PLACES, "right")))
        part = counts[at:end]
        period = np.repeat(q[at:end], part)
        step = np.arange(len(period)) - np.repeat(np.cumsum(part) - part, part)
        yield np.repeat(starts[owner[at:end]], part) + step * period, period
        at = end


def find_runs(words, sizes, least=LEAST):
    """Start, end and period of every run of the texts laid end to end, by start and period.

    ``words`` has equal numbers for equal words, ``sizes`` the words of each text.
    """
    # A wall, a number of its own, stands before each text and after the last.
    sizes = np.asarray(sizes, np.int64)
    n_texts = len(sizes)
    starts = np.cumsum(sizes + 1) - sizes
    sequence = np.empty(len(words) + n_texts + 1, np.int64)
    walls = np.zeros(len(sequence), bool)
    walls[np.append(0, starts + sizes)] = True
    sequence[~walls] = words
    sequence[walls] = int(np.max(words, initial=-1)) + 1 + np.arange(n_texts + 1)
    side = -(-(-(-least // 2) - 1) // 2)  # further matches that a run has on one side at least
    padded = np.concatenate((-1 - np.arange(side), sequence, -1 - side - np.arange(side)))
    covering, covered_to = np.zeros(len(sequence), np.int64), np.zeros(len(sequence), np.int64)
    long_enough = np.flatnonzero(sizes >= least)
    grammar, found, low = None, [], 1
    while low <= int(sizes.max(initial=0)) // 2:
        chosen = []
        for i, q in _grid(starts[long_enough], sizes[long_enough], low, low * CLASS):
            equal = np.flatnonzero(sequence[i] == sequence[i + q])
            i, q = i[equal], q[equal]
            after, before = np.ones(len(i), bool), np.ones(len(i), bool)
            for d in range(1, side + 1):
                after &= padded[side + i + d] == padded[side + i + q + d]
                before &= padded[side + i - d] == padded[side + i + q - d]
            known = (covering[i] > 0) & (q % np.maximum(covering[i], 1) == 0) & (i + q < covered_to[i])
            keep = (after | before) & ~known
            chosen.append((i[keep], q[keep]))
        low *= CLASS
        i, q = (np.concatenate(c) for c in zip(*chosen)) if chosen else (np.zeros(0, np.int64),) * 2
        if not len(i):
            continue
        grammar = grammar or Grammar(sequence, walls)
        start = i - grammar.extensions(i, i + q, False)
        end = i + q + grammar.extensions(i, i + q, True)
        good = end - start >= np.maximum(least, 2 * q)
        new = np.stack((start[good], end[good], q[good]), axis=1)
        if len(new):
            new = new[np.lexsort((new[:, 2], new[:, 1], new[:, 0]))]
            # Of equal stretches the smallest period counts.
            new = new[np.append(True, (new[1:, :2] != new[:-1, :2]).any(axis=1))]
            found.append(new)
            for s, e, p in new[np.argsort(new[:, 1] - new[:, 0], kind="stable")].tolist():
                covering[s:e], covered_to[s:e] = p, e
    if not found:
        return np.zeros((0, 3), np.int64), starts
    runs = np.concatenate(found)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    runs = runs[np.append(True, (runs[1:, :2] != runs[:-1, :2]).any(axis=1))]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))], starts


def _collapsed(words, runs):
    """Words but those that a run repeats, joined by blanks; runs start in the text."""
    if not len(runs):
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 1], -1)
    kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
    return b" ".join([words[i] for i in kept.tolist()])


def _scan(name, least):
    def run(batches):
        for batch in batches:
            texts = column_bytes(batch, name)
            for first, last in groups(texts):
                split = [t.split() for t in texts[first:last]]
                index = {}
                numbers = np.array([index.setdefault(w, len(index)) for ws in split for w in ws], np.int64)
                runs, starts = find_runs(numbers, [len(ws) for ws in split], least)
                owner = np.searchsorted(starts, runs[:, 0], "right") - 1
                bounds = np.searchsorted(owner, np.arange(len(split) + 1))
                runs[:, :2] -= starts[owner][:, None]
                texts_out = [_collapsed(ws, runs[bounds[k] : bounds[k + 1]]) for k, ws in enumerate(split)]
                parts = pa.StructArray.from_arrays(
                    [pa.array(runs[:, 0]), pa.array(runs[:, 1] - runs[:, 0]), pa.array(runs[:, 2].copy())],
                    names=["start", "length", "period"],
                )
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), parts)
                own = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays(
                    [*own.columns, lists, pa.array(texts_out, pa.binary()).cast(pa.string())],
                    names=[f"c{k}" for k in range(own.num_columns + 2)],
                )

    return run


RUNS_TYPE = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))


def word_runs(docs, text="text", least=LEAST):
    """The rows with their runs, by start and period, and the text without the repeats."""
    runs, collapsed = fresh(docs, "runs", "collapsed")
    places = [T.StructField(f"c{k}", f.dataType) for k, f in enumerate(docs.schema.fields)]
    schema = T.StructType([*places, T.StructField(f"c{len(places)}", RUNS_TYPE), T.StructField(f"c{len(places) + 1}", T.StringType())])
    at = f"c{docs.columns.index(text)}"
    plain = docs.toDF(*[f.name for f in places])
    return plain.mapInArrow(_scan(at, least), schema).toDF(*docs.columns, runs, collapsed)


def planted(docs):
    """Texts of one document in ten with their tail made periodic, as the query's contract says."""
    mark = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(mark / 10)
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"))
    chosen = docs.select("doc_id", "text", F.when(mark % 10 == 0, words).alias("words"), g.alias("g"))
    chosen = chosen.withColumn("n", F.size("words").cast("long"))
    chosen = chosen.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    chosen = chosen.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    a, rest = F.col("a").cast("int"), (F.col("n") - F.col("a")).cast("int")
    times = F.ceil(rest / F.col("p")).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice("words", a + 1, F.col("p")), times)), F.lit(1), rest)
    made = F.concat_ws(" ", F.concat(F.slice("words", F.lit(1), a), tail))
    return chosen.select("doc_id", F.when(F.col("n") > 0, made).otherwise(F.col("text")).alias("text"))
