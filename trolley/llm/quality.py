"""Quality rules: repetition counts and distance from language references.

Every text is scanned once into a few counts and two histograms, of character
classes and of common words. Each language's reference is the mean histogram of
its own documents that pass the count rules, taken over all of them. A document
is rejected when its Jensen-Shannon distance (base 2, 0 to 1) to every reference
exceeds the limits, so a wrong language label alone rejects nothing.

Edge cases: a null text counts as empty; empty texts have zero words and fail
the count rules; documents with a language other than ``LANGUAGES`` (or none) are
judged against all references but add to none; without references (an empty
table, or none that passes) the count rules alone decide. Histograms of fewer
than ``min_words`` words are not compared. Repeated rows are rows of their own,
and other columns of the input are ignored.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from trolley.llm.common import stored
from trolley.llm.textscan import column_bytes, groups, mix, runs, word_hashes

# Frequent function words of each language.
COMMON_WORDS = {
    "en": "the of and to in a is that it for was on are as with be by this at from or an".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es".split(),
    "fr": "de la le et les des en un du une que est pour qui dans par sur au avec plus pas ne".split(),
    "es": "de la que el en y a los se del las un por con una su para es al lo como más".split(),
}
LANGUAGES = tuple(COMMON_WORDS)
VOCABULARY = sorted({w for words in COMMON_WORDS.values() for w in words})
CLASSES = ("lower", "upper", "beyond_ascii", "digit", "space", "stop", "symbol")
SYMBOLS = b"#*$%&|<>"
N_CLASSES, N_WORDS = len(CLASSES), len(VOCABULARY) + 1  # the last word bin holds all other words
SCALE = 1_000_000  # shares are summed as whole millionths, so sums do not depend on order

_SCHEMA = (
    "doc_id long, lang string, n_chars long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, char_hist array<long>, word_hist array<long>"
)


def _classes():
    kind = np.full(256, CLASSES.index("symbol"), np.uint8)
    kind[0x80:0xC0] = N_CLASSES  # inside a character
    kind[0xC0:] = CLASSES.index("beyond_ascii")
    for name, members in (
        ("lower", b"abcdefghijklmnopqrstuvwxyz"), ("upper", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        ("digit", b"0123456789"), ("space", b" \t\n\v\f\r"), ("stop", b".,;:!?'\"()-"),
    ):
        kind[list(members)] = CLASSES.index(name)
    return kind


_KIND = _classes()
_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True


def _duplicate_lines(text):
    """Lines with a word that equal an earlier line."""
    seen, n = set(), 0
    for line in text.split(b"\n"):
        if line in seen:
            n += bool(line.strip(b" \t\v\f\r"))
        else:
            seen.add(line)
    return n


def _repeated_words(owners, hashes, count):
    """Per text, the words inside 3-word windows found twice or more in it."""
    at, windows = runs(owners, hashes, 3)
    keyed = windows ^ mix(owners[at].astype(np.uint64))
    order = np.argsort(keyed)
    in_order = keyed[order]
    same = in_order[1:] == in_order[:-1]
    again = np.zeros(len(at), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    covered = np.zeros(len(owners), bool)
    for k in range(3):
        covered[at[again] + k] = True
    return np.bincount(owners[covered], minlength=count)


def _counts(batches):
    common = word_hashes([w.encode() for w in VOCABULARY])[1]
    order = np.argsort(common)
    table = common[order]
    for batch in batches:
        texts = column_bytes(batch, "text")
        parts = []
        for start, end in groups(texts):
            part = texts[start:end]
            n = len(part)
            owners, hashes = word_hashes(part)
            n_words = np.bincount(owners, minlength=n)
            chars = np.zeros((n, N_CLASSES), np.int64)
            symbols = np.zeros(n, np.int64)
            for i, text in enumerate(part):
                byte = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
                chars[i] = np.bincount(_KIND, weights=byte, minlength=N_CLASSES + 1)[:N_CLASSES]
                symbols[i] = byte[_IS_SYMBOL].sum()
            low_owners, low = word_hashes([t.lower() for t in part])
            slot = np.searchsorted(table, low)
            slot[slot == len(table)] = 0
            known = table[slot] == low
            words = np.zeros((n, N_WORDS), np.int64)
            np.add.at(words, (low_owners[known], order[slot[known]]), 1)
            words[:, -1] = n_words - words.sum(1)
            parts.append((
                chars.sum(1), n_words, chars.sum(1) - chars[:, CLASSES.index("space")], symbols,
                np.array([_duplicate_lines(t) for t in part]),
                _repeated_words(owners, hashes, n), chars, words,
            ))
        if not parts:
            continue
        columns = [np.concatenate([p[k] for p in parts]) for k in range(8)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "lang")]
            + [pa.array(c.astype(np.int64)) for c in columns[:6]]
            + [pa.array(list(c), pa.list_(pa.int64())) for c in columns[6:]],
            names=[part.split()[0] for part in _SCHEMA.split(", ")],
        )


def document_counts(docs):
    """Counts and histograms per document, with ``base_failed`` from the count rules."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.col("text").cast("string"))
    return rows.mapInArrow(_counts, _SCHEMA).withColumn(
        "base_failed",
        (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
    )


def references(counts):
    """One row per language of ``LANGUAGES`` with passing documents: its mean histograms.

    A document counts once whatever its length. Shares are rounded to whole
    millionths before they are summed, so reruns agree to the last digit.
    """
    def shares(name, total, size):
        return [F.sum(F.floor(F.col(name)[k] * SCALE / F.col(total))).alias(f"{name}_{k}") for k in range(size)]

    kept = counts.filter(~F.col("base_failed") & F.col("lang").isin(*LANGUAGES))
    sums = kept.groupBy("lang").agg(
        *shares("char_hist", "n_chars", N_CLASSES), *shares("word_hist", "n_words", N_WORDS)
    )
    return sums.select(
        "lang",
        F.array(*[f"char_hist_{k}" for k in range(N_CLASSES)]).alias("char_hist"),
        F.array(*[f"word_hist_{k}" for k in range(N_WORDS)]).alias("word_hist"),
    )


def _distance(name, total, reference):
    """Jensen-Shannon distance of the histogram column to a list of counts."""
    whole = sum(reference)
    known = F.array(*[F.lit(share / whole) for share in reference])
    shares = F.transform(name, lambda n: n / F.col(total))

    def term(p, q):
        part = lambda x: F.when(x > 0, x * F.log2(2 * x / (p + q))).otherwise(0.0)
        return part(p) + part(q)

    terms = F.zip_with(shares, known, term)
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda a, x: a + x) / 2, F.lit(0.0)))


def judge(counts, reference_rows, char_limit=0.3, both_limits=(0.14, 0.3), min_words=50):
    """Add the smallest distances and ``kept``.

    Rejected is a text whose character classes are further than ``char_limit``
    from every reference, or whose character classes and common words both
    exceed ``both_limits``. ``reference_rows`` are the rows of ``references``, at
    most one a language.
    """
    def nearest(name, total):
        distances = [_distance(name, total, row[name]) for row in reference_rows if sum(row[name])]
        if not distances:
            return F.lit(None).cast("double")
        best = F.least(*distances) if len(distances) > 1 else distances[0]
        return F.round(F.when(F.col("n_words") >= min_words, best), 6)

    judged = counts.withColumns({
        "char_distance": nearest("char_hist", "n_chars"),
        "word_distance": nearest("word_hist", "n_words"),
    })
    chars, words = (F.coalesce(F.col(c), F.lit(0.0)) for c in ("char_distance", "word_distance"))
    far = (chars > char_limit) | ((chars > both_limits[0]) & (words > both_limits[1]))
    return judged.withColumn("kept", ~F.col("base_failed") & ~far)


def quality_rules(docs, char_limit=0.3, both_limits=(0.14, 0.3), min_words=50):
    """Counts, distances and verdict per document; the texts are scanned once.

    To the driver come only the references, one row per language of
    ``LANGUAGES``.
    """
    counts = stored(document_counts(docs), "quality_counts")
    return judge(counts, references(counts).collect(), char_limit, both_limits, min_words)
