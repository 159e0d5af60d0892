"""Words and word shingles of many texts at once, as numpy arrays.

Texts are scanned in groups of about ``GROUP`` bytes, so memory follows the
group, or one longer text, and not the Arrow batch. A word is a run of bytes
other than ASCII white space; UTF-8 never uses those bytes inside a character,
so byte and character words agree.
"""

import numpy as np

GROUP = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_powers = {}


def _series(base, n):
    """1, base, base^2 ... as wrapping 64-bit numbers."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        full = np.full(max(n, GROUP + 1), base, np.uint64)
        full[0] = 1
        known = _powers[base] = np.cumprod(full)
    return known[:n]


def mix(x):
    """Scramble 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def groups(texts, size=GROUP):
    """Index ranges of consecutive texts of about ``size`` bytes together."""
    start = total = 0
    for i, text in enumerate(texts):
        if total and total + len(text) > size:
            yield start, i
            start, total = i, 0
        total += len(text)
    if start < len(texts):
        yield start, len(texts)


def _pieces(text, size):
    """Cut a long text at white space; a longer word stays whole."""
    at = 0
    while len(text) - at > size:
        cut = max(text.rfind(c, at, at + size) for c in (b" ", b"\t", b"\n", b"\v", b"\f", b"\r"))
        if cut <= at:
            ends = [e for c in (b" ", b"\t", b"\n", b"\v", b"\f", b"\r") if (e := text.find(c, at + size)) >= 0]
            cut = min(ends, default=len(text) - 1)
        yield text[at : cut + 1]
        at = cut + 1
    yield text[at:]


def _word_hash(data, prefix):
    """Start and hash of every word, or of its first bytes, of one byte array."""
    edge = np.diff(np.concatenate(([True], _SPACE[data], [True])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(starts):
        return starts, np.zeros(0, np.uint64)
    if prefix:
        ends = np.minimum(ends, starts + prefix)
    lengths = ends - starts
    if len(data) > 4 * GROUP:  # only a word longer than a group gets here
        hashes = np.array([_long_hash(data[s:e]) for s, e in zip(starts, ends)], np.uint64)
    else:
        n = len(data)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _series(_BASE, n), out=total[1:])
        inverse = _series(pow(_BASE, -1, 1 << 64), n + 1)
        hashes = (total[ends] - total[starts]) * inverse[starts]
    return starts, mix(hashes ^ (lengths.astype(np.uint64) << np.uint64(40)))


def _long_hash(data):
    total = 0
    for at in range(0, len(data), GROUP):
        part = data[at : at + GROUP].astype(np.uint64) + np.uint64(1)
        total += pow(_BASE, at, 1 << 64) * int(np.sum(part * _series(_BASE, len(part))))
    return total & _MASK


def word_hashes(texts, prefix=None):
    """Text number and hash of every word, or word prefix, of the texts, in order."""
    owners, hashes = [], []
    short, first = [], 0

    def flush():
        if short:
            sizes = np.array([len(t) + 1 for t in short])
            bounds = np.cumsum(sizes)
            starts, found = _word_hash(np.frombuffer(b" ".join(short), np.uint8), prefix)
            owners.append(first + np.searchsorted(bounds, starts, "right"))
            hashes.append(found)
            short.clear()

    for i, text in enumerate(texts):
        if len(text) <= GROUP:
            if not short:
                first = i
            short.append(text)
            continue
        flush()
        for piece in _pieces(text, GROUP):
            _, found = _word_hash(np.frombuffer(piece, np.uint8), prefix)
            owners.append(np.full(len(found), i))
            hashes.append(found)
    flush()
    if not hashes:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(owners).astype(np.int64), np.concatenate(hashes)


def runs(owners, hashes, width):
    """Position and hash of every window of ``width`` words within one text."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.flatnonzero(owners[:n] == owners[width - 1 :])
    value = np.zeros(len(at), np.uint64)
    for k in range(width):
        value = value * np.uint64(0xD6E8FEB86659FD93) + hashes[at + k]
    return at, mix(value)


def column_bytes(batch, name):
    """The column's texts as bytes; null is empty."""
    import pyarrow as pa
    import pyarrow.compute as pc

    column = pc.fill_null(batch.column(batch.schema.get_field_index(name)).cast(pa.large_string()), "")
    return column.cast(pa.large_binary()).to_pylist()
