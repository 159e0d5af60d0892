"""Licence notices in texts: MinHash bands over windows, verified by containment.

Words are runs of letters and digits, lower-cased; shingles have five words. Texts
are covered by overlapping windows of three sizes. A template belongs to the
largest size of which a whole window always fits into an unbroken copy of it
(window + stride - 1 <= length), and contributes the windows at each of its
words, so an exact copy holds a window equal to one of the template's, which meets it
for certain; windows with a Jaccard similarity of ``SIMILARITY`` meet one with
probability 1 - (1 - SIMILARITY^ROWS)^BANDS, over 0.99. The smallest windows have one
shingle and meet exactly.

Each text and template that meet are verified on all shingles of the text: at
least ``containment`` of the template's distinct shingles must occur, and one at least
of each of its telling passages (name and version, where licences of a family hardly
differ otherwise). There is one row for each.

Edge cases: null and empty texts and texts below five words match nothing; a
template needs five words or more (else an error) and no templates give no rows; a
notice counts once per text however often it occurs; repeated rows match each by
themselves; a null doc_id is kept. Other columns are ignored.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from trolley.llm.license_texts import LICENSE_TELLING, LICENSE_TEXTS
from trolley.llm.textscan import column_bytes, groups, mix, runs, word_hashes

SHINGLE = 5
# Window and stride in words; the first is a single shingle at every word.
SCALES = ((5, 1), (16, 8), (64, 32))
BANDS, ROWS, SIMILARITY = 16, 2, 0.5
_STEP = 4  # shingles whose minima are taken together
_ALIGN = 32
_FILTER = 1 << 20

_FOLD = bytes(
    c if c >= 128 or chr(c).isdigit() or chr(c).islower() else ord(chr(c).lower()) if chr(c).isupper() else 32
    for c in range(256)
)
_SEEDS = mix(np.arange(1, 2 * BANDS * ROWS + 1, dtype=np.uint64))


def _shingles(texts):
    owners, hashes = word_hashes([t.translate(_FOLD) for t in texts])
    at, found = runs(owners, hashes, SHINGLE)
    first = np.searchsorted(owners, np.arange(len(texts)))
    return owners[at], at - first[owners[at]], found


def _bands(minima, scale):
    """Band keys (windows x BANDS) from a function that gives each hash's window minima."""
    keys = []
    for band in range(BANDS):
        key = np.uint64(scale * 1000 + band)
        for k in range(band * ROWS, (band + 1) * ROWS):
            key = mix(minima(_SEEDS[2 * k] | np.uint64(1), _SEEDS[2 * k + 1]) ^ key)
        keys.append(key)
    return np.stack(keys, axis=1)


class Templates:
    """Shingle sets of the templates and the band keys that retrieve them."""

    def __init__(self, texts, telling=None):
        self.names = list(texts)
        self.telling = [
            [_shingles([passage.encode()])[2] for passage in (telling or {}).get(name, ())] for name in self.names
        ]
        self.sets, keys, owners = [], [], []
        for n, text in enumerate(texts.values()):
            shingles = _shingles([text.encode()])[2]
            if not len(shingles):
                raise ValueError(f"template {self.names[n]!r} has fewer than {SHINGLE} words")
            self.sets.append(np.unique(shingles))
            length = len(shingles) + SHINGLE - 1
            scale = max(k for k, (window, stride) in enumerate(SCALES) if k == 0 or window + stride - 1 <= length)
            width = SCALES[scale][0] - SHINGLE + 1
            windows = np.lib.stride_tricks.sliding_window_view(shingles, width)
            if scale == 0:
                found = mix(windows[:, 0])
            else:
                found = _bands(lambda a, b, windows=windows: (windows * a + b).min(1), scale).ravel()
            keys.append(found)
            owners.append(np.full(len(found), n))
        keys = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.owners = keys[order], (np.concatenate(owners) if owners else np.zeros(0, int))[order]
        self.maybe = np.zeros(_FILTER, bool)
        self.maybe[(self.keys & np.uint64(_FILTER - 1)).astype(np.int64)] = True

    def lookup(self, keys):
        """(place in keys, template) for every template met."""
        place = np.flatnonzero(self.maybe[(keys & np.uint64(_FILTER - 1)).astype(np.int64)])
        lo = np.searchsorted(self.keys, keys[place], "left")
        n = np.searchsorted(self.keys, keys[place], "right") - lo
        place, lo, n = place[n > 0], lo[n > 0], n[n > 0]
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return np.repeat(place, n), self.owners[np.repeat(lo, n) + within]


def scan(texts, templates, containment=0.8):
    """(text number, template number, shared shingles, first word, last word) of every match."""
    owners, words, shingles = _shingles(texts)
    if not len(shingles) or not templates.names:
        return []
    place, template = templates.lookup(mix(shingles))
    met = [owners[place] * len(templates.names) + template]
    # Each text begins at a fixed phase and is followed by room, so its windows hold no other text.
    sizes = np.bincount(owners, minlength=len(texts))
    room = (sizes + _ALIGN - 1) // _ALIGN * _ALIGN + 2 * _ALIGN
    starts = np.cumsum(room) - room
    begin = np.cumsum(sizes) - sizes
    slot = np.arange(len(shingles)) - begin[owners] + starts[owners]
    used = np.zeros(room.sum(), bool)
    used[slot] = True
    for scale, (window, stride) in enumerate(SCALES[1:], 1):
        blocks, step = (window - SHINGLE + 1) // _STEP, stride // _STEP
        some = np.lib.stride_tricks.sliding_window_view(used.reshape(-1, _STEP).any(1), blocks)[::step].any(1)
        windows = np.flatnonzero(some)

        def minima(a, b, blocks=blocks, step=step, windows=windows):
            laid = np.full(len(used), np.iinfo(np.uint64).max, np.uint64)
            laid[slot] = shingles * a + b
            low = laid.reshape(-1, _STEP).min(1)
            found = low[:-blocks + 1].copy()
            for k in range(1, blocks):
                np.minimum(found, low[k : len(low) - blocks + 1 + k], out=found)
            return found[::step][windows]

        place, template = templates.lookup(_bands(minima, scale).ravel())
        where = windows[place // BANDS] * stride
        text = np.searchsorted(starts, where, "right") - 1
        met.append(text * len(templates.names) + template)
    matches = []
    for pair in np.unique(np.concatenate(met)).tolist():
        text, template = divmod(pair, len(templates.names))
        span = slice(begin[text], begin[text] + sizes[text])
        wanted = templates.sets[template]
        hit = np.isin(shingles[span], wanted)
        shared = len(np.unique(shingles[span][hit]))
        if shared >= containment * len(wanted) and all(np.isin(t, shingles[span]).any() for t in templates.telling[template]):
            at = words[span][hit]
            matches.append((text, template, shared, int(at.min()), int(at.max()) + SHINGLE - 1))
    return matches


def license_matches(docs, texts=None, containment=0.8, telling=None):
    """doc_id, license, n_shared, n_template, first_word and last_word of every match."""
    if texts is None:
        texts, telling = LICENSE_TEXTS, LICENSE_TELLING
    Templates(texts, telling)  # faulty templates fail here, not in a task

    def run(batches):
        templates = Templates(texts, telling)
        for batch in batches:
            plain, ids = column_bytes(batch, "text"), batch.column(0).to_pylist()
            rows = []
            for start, end in groups(plain):
                for text, template, shared, first, last in scan(plain[start:end], templates, containment):
                    rows.append((ids[start + text], templates.names[template], shared, len(templates.sets[template]), first, last))
            if rows:
                columns = [list(c) for c in zip(*rows)]
                kinds = (pa.int64(), pa.string(), *[pa.int64()] * 4)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)],
                    names=["doc_id", "license", "n_shared", "n_template", "first_word", "last_word"],
                )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(
        run, "doc_id long, license string, n_shared long, n_template long, first_word long, last_word long"
    )
