"""Source divergence, periodic runs and shards: brute force, odd tables, bounds."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tests.llm.test_cases import CLASH, HARD, LONG, docs, prose
from trolley.llm import sharding, source_audit, word_runs
from trolley.llm.common import stored
from trolley.llm.queries import QUERIES


def divergence(rows, least_docs, first):
    """(lang, source, part, item, value, rank) from (text, lang, source), with Python's own numbers."""
    hits, in_docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")
        counted = Counter(re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in words)
        hits[lang, source].update(counted)
        in_docs[lang].update(counted.keys())
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted(t for t, n in in_docs[lang].items() if n >= least_docs)
        sources = sorted(s for x, s in groups if x == lang)

        def share(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p = {s: share(hits[lang, s]) for s in sources}
        q = share(sum((hits[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, p[s][t] - q[t]) for t in kept if hits[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, t, v, k) for k, (t, v) in enumerate(ranked, 1) if part == "pair" or k <= first]
    return sorted(out)


def audit(df, **options):
    return sorted(map(tuple, source_audit.source_divergence(df, **options).collect()))


def audit_rows(n=400):
    rng = random.Random(5)
    words = ["Stone", "river", "ÀÉ", "éÉ", "日本", "light2green", "x", "Zz", "don't", "a_b", "\x00nul", "ǅ"]
    rows = []
    for i in range(n):
        lang, source = rng.choice(["en", "fr", None, ""]), rng.choice(["s1", "s2", "S2", "é", None, ""])
        picked = rng.choices(words, weights=[rng.random() + 0.1 for _ in words], k=rng.randrange(12))
        rows.append((i, rng.choice([None, "", " \t", *[" ".join(picked)] * 9]), lang, source))
    rows += [(n + i, prose(i, 30), "de", "s1") for i in range(40)] + [(999, None, "xx", "s1"), (999, "", "xx", "s2"), (None, "q", "xx", "s3")]
    return rows + rows[:50]


@pytest.mark.parametrize("bounds", [{}, {"HELD": 3, "PIECE": 8, "BUCKET": 2, "TILE": 2}])
def test_divergence_equals_brute_force(spark, monkeypatch, bounds):
    """Also with bounds so small that sums, buckets and tiles are many (workers see them only where set before)."""
    for name, value in bounds.items():
        monkeypatch.setattr(source_audit, name, value)
    rows = audit_rows()
    got = audit(docs(spark, rows), least_docs=5, first=4)
    assert got == divergence([r[1:] for r in rows], 5, 4)


def test_divergence_of_empty_and_bare_tables(spark):
    empty = docs(spark, []).limit(0)
    assert audit(empty) == []
    bare = docs(spark, [(1, "a b", "en", "x"), (2, None, "en", "y"), (3, "c", "fr", None)])
    assert audit(bare) == [("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)]


def test_term_counts_cut_long_texts(monkeypatch):
    text = ("Ab " * 5000 + "c" * 3000 + " \n" + "É2é " * 700).encode()
    whole = source_audit.term_counts(text)
    monkeypatch.setattr(source_audit, "PIECE", 100)
    assert source_audit.term_counts(text) == whole == Counter({b"ab": 5000, b"c" * 3000: 1, "É".encode(): 700, "é".encode(): 700})


def test_shares_are_exact_for_large_counts():
    counts, total, v = np.array([0, 7, 10**12, 3 * 10**15 - 1]), np.array([8 * 10**15]), 10**8
    want = [1 + 10**9 * (int(c) + 5) // (8 * 10**15 + 5 * v) for c in counts]
    assert source_audit.shares(counts, total, v).tolist() == want


# --- runs -------------------------------------------------------------------

def runs_of(w, least=12):
    """(start, length, period) of all runs, by comparing every two places."""
    best = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i > s and i + q - s >= max(least, 2 * q):
                best.setdefault((s, i + q - s), q)
            i += i == s
    return sorted((s, length, q) for (s, length), q in best.items())


def collapse(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_runs_equal_brute_force_on_random_words():
    rng = random.Random(1)
    for _ in range(600):
        texts = []
        for _ in range(rng.randrange(1, 5)):
            k, n = rng.choice([1, 2, 2, 3, 5, 30]), rng.choice([0, 3, 12, 13, 40, 90, 150])
            w = [rng.randrange(k) for _ in range(n)]
            for _ in range(rng.randrange(3) if n > 12 else 0):
                a, p = rng.randrange(n), rng.randrange(1, n // 2)
                for i in range(a, rng.randrange(a, n) + 1):
                    w[i] = w[a + (i - a) % p]
            texts.append(w)
        least = rng.choice([12, 12, 2, 7])
        runs, starts = word_runs.find_runs(np.array([x for w in texts for x in w], np.int64), [len(w) for w in texts], least)
        want = [(at + s, at + s + n, q) for w, at in zip(texts, starts.tolist()) for s, n, q in runs_of(w, least)]
        assert runs.tolist() == [list(x) for x in sorted(want, key=lambda x: (x[0], x[2]))] or sorted(map(tuple, runs.tolist())) == sorted(want)


def test_extensions_equal_comparison():
    rng = np.random.default_rng(2)
    for kinds in (1, 2, 4):
        words = rng.integers(0, kinds, 400)
        words[150:350] = np.resize(words[150:163], 200)
        sequence = np.concatenate(([90], words, [91]))
        walls = np.zeros(402, bool)
        walls[[0, -1]] = True
        grammar = word_runs.Grammar(sequence, walls)
        a = rng.integers(1, 400, 500)
        b = np.where((b := rng.integers(1, 400, 500)) == a, a % 399 + 1, b)
        for forward in (True, False):
            got = grammar.extensions(a, b, forward)
            for x, y, n in zip(a.tolist(), b.tolist(), got.tolist()):
                step = 0
                while sequence[x + step if forward else x - 1 - step] == sequence[y + step if forward else y - 1 - step]:
                    step += 1
                assert n == step


def test_word_runs_keep_columns_and_odd_rows(spark):
    period = " ".join(f"w{i}" for i in range(7))
    rows = [*HARD, (20, f"start  {period}\n{period}\t{period} w0 end"), (21, "a " * 40), (22, "a b " * 3000 + "c")]
    table = docs(spark, rows).withColumn("runs", F.lit(1)).withColumn("Collapsed", F.lit("mine"))
    found = word_runs.word_runs(table)
    assert found.columns == [*table.columns, "_runs", "_collapsed"]
    for r in found.collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        want = runs_of(words) if len(words) < 5000 else ([(0, 6000, 2)] if r.doc_id == 22 else None)
        got = [tuple(x) for x in r["_runs"]]
        if want is not None:
            assert got == want
        assert r["_collapsed"] == collapse(words, got) and r.runs == 1 and r.Collapsed == "mine"
    by_id = {r.doc_id: r["_collapsed"] for r in found.filter("doc_id > 19").collect()}
    assert by_id == {20: f"start {period} end", 21: "a", 22: "a b c"}
    assert word_runs.word_runs(table.limit(0)).count() == 0


def test_long_repeats_take_n_log_n():
    for words in (np.zeros(300_000, np.int64), np.arange(300_000) % 2, np.arange(300_000) % 977):
        runs, _ = word_runs.find_runs(words, [len(words)])
        assert runs.tolist() == [[1, 300_001, len(set(words[:1000].tolist()))]]


# --- shards -----------------------------------------------------------------

def check_shards(rows, n_shards, slack):
    """Rows (shard, slot, text): every slot once, groups whole unless too large, bytes near equal."""
    slots, size, groups, group_bytes = defaultdict(list), Counter(), defaultdict(set), Counter()
    for shard, slot, text in rows:
        n = len((text or "").encode()) + 1
        slots[shard].append(slot)
        size[shard] += n
        groups[text or ""].add(shard)
        group_bytes[text or ""] += n
    mean = sum(size.values()) / n_shards
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(n_shards))
    assert all(len(where) == 1 for text, where in groups.items() if group_bytes[text] <= mean)
    assert all(abs(size[s] - mean) <= slack * mean + 1 for s in range(n_shards))


def sharded(df, **options):
    return [(r["shard"], r["slot"], r["text"]) for r in sharding.shard_documents(df, **options).collect()]


def test_shards_of_the_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    check_shards(sharded(table), 16, 0.02)
    check_shards(sharded(table, n_shards=5, part_bytes=20_000), 5, 0.006)
    first = sorted(map(tuple, QUERIES["op13_shards"](spark, SMALL).collect()))
    texts = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert {r[0] for r in first} == set(texts) and len(first) == len(texts)
    assert all((r[1], r[2], r[3], r[6]) == (len(texts[r[0]]) + 1, zlib.crc32(texts[r[0]]), "bytes", None) for r in first)


def test_shards_with_hot_groups(spark):
    """A third of all rows are one row, another group nearly fills a shard."""
    rows = [(i, f"{i} {prose(i, 30)}") for i in range(600)] + [(7, prose(7, 20))] * 500 + [(i, prose(8, 25)) for i in range(45)]
    rows += [(i, None) for i in range(9)] + [(i, "") for i in range(9)]
    check_shards(sharded(docs(spark, rows), n_shards=16, part_bytes=3000), 16, 0.02)


def test_shards_keep_columns_and_odd_rows(spark, tmp_path):
    table = docs(spark, HARD * 3).withColumn("Shard", F.lit("s")).withColumn("slot", F.lit(1)).withColumn("c0", F.lit(2))
    found = sharding.shard_documents(table, n_shards=3)
    assert found.columns == [*table.columns, "_shard", "_slot"]
    assert sorted(map(str, found.drop("_shard", "_slot").collect())) == sorted(map(str, table.collect()))
    assert sharding.shard_documents(table.limit(0)).count() == 0
    kept = stored(sharding.shard_documents(docs(spark, HARD), n_shards=2), "test_shards")
    sharding.write_shards(kept, str(tmp_path / "out"))
    again = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(str, again.select(kept.columns).collect())) == sorted(map(str, kept.collect()))


def test_room_and_deal():
    placed, given = sharding.deal([(1, 50), (2, 40), (3, 40), (4, 5)], 3)
    assert given == [50, 45, 40] and placed[1] == 0
    assert sharding.room(150, [50, 45, 40]) == [0.0, 5.0, 10.0]
    assert sharding.room(120, [90, 0, 0]) == [0.0, 15.0, 15.0]
