"""The registered queries: SQL twins, and brute force where SQL has no form."""

import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from checks.compare import difference
from tests.conftest import SMALL
from trolley.llm.common import stored
from trolley.llm.oracle import ORACLES
from trolley.llm.queries import QUERIES


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("documents", "embeddings", "pages", "benchmark", "labels"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, duck, name):
    assert difference(QUERIES[name](spark, SMALL), duck, ORACLES[name]) is None


def test_names():
    assert set(ORACLES) <= set(QUERIES)
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES if n != "pipeline")
    assert numbers == list(range(1, 14)) and "pipeline" in QUERIES


def documents(spark):
    return sorted(map(tuple, spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()))


def test_token_files_equal_the_library(spark):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want, start = [], 0
    for doc_id, text in documents(spark):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, QUERIES["op7_token_files"](spark, SMALL).collect())) == want


def test_sampled_pieces_are_lossless_and_repeat(spark):
    first = sorted(map(tuple, QUERIES["op2_sampled_pieces"](spark, SMALL).collect()))
    again = sorted(map(tuple, QUERIES["op2_sampled_pieces"](spark, SMALL).repartition(3).collect()))
    assert first == again and len(first) == len(documents(spark)) and all(row[3] for row in first)


def test_toxicity_holds_out(spark):
    rows = QUERIES["op8_toxicity"](spark, "/root/testdata/sf0.01").collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == int(r.score >= 0.7) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    toxic = [r.score for r in held if labels[r.doc_id]]
    clean = [r.score for r in held if not labels[r.doc_id]]
    assert np.mean([np.mean(np.array(clean) < t) for t in toxic]) > 0.9  # ranks toxic above clean
    assert np.mean(np.array(clean) >= 0.7) < 0.02


def test_pages_give_their_articles(spark):
    import html
    import re

    got = {r.page_id: r for r in QUERIES["op9_html_text"](spark, SMALL).collect()}
    for page in spark.read.parquet(f"{SMALL}/pages.parquet").collect():
        article = re.search(r"<article>(.*?)</article>", page.html, re.S)[1]
        blocks = (" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article))
        want = "\n".join(b for b in blocks if b)
        assert got[page.page_id].text == want and got[page.page_id].n_chars == len(want)


def test_license_scan_equals_brute_force(spark):
    from trolley.llm.license_scan import _FOLD
    from trolley.llm.license_texts import LICENSE_TEXTS

    def shingles(text):
        words = text.encode().translate(_FOLD).decode().split()
        return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}

    want = {
        (doc_id, name)
        for doc_id, text in documents(spark)
        for name, template in LICENSE_TEXTS.items()
        if len(shingles(text or "") & shingles(template)) >= 0.8 * len(shingles(template))
    }
    got = [(r.doc_id, r.license) for r in QUERIES["op4_license_scan"](spark, SMALL).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    counts = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SMALL), "test_stage")
        if name != "sampled_pieces":
            assert docs.columns == columns
        counts.append(docs.count())
    assert counts[0] >= counts[1] == counts[2] and counts[3] == counts[4] > 0
    assert docs.count() == QUERIES["pipeline"](spark, SMALL).count()
