"""The registered queries of this subpackage: name -> function of (session, folder)."""

from pyspark.sql import functions as F

import corpus_pipeline
from trolley.llm import (
    embeddings, html_text, license_scan, mixing, near_duplicates, pieces, pii, quality, sharding, source_audit,
    token_files, toxicity, word_runs,
)
from trolley.llm.common import table


def op10_quality_rules(spark, folder):
    judged = quality.quality_rules(table(spark, folder, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op1_embedding_near_dedup(spark, folder):
    return embeddings.near_vectors(table(spark, folder, "embeddings"), cosine=0.9)


def op2_sampled_pieces(spark, folder):
    import public_tokenizers

    return pieces.round_trips(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op3_pii_pseudonyms(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, findings="n_replaced")


def op4_license_scan(spark, folder):
    return license_scan.license_matches(table(spark, folder, "documents"))


def op5_minhash_near_dedup(spark, folder):
    return near_duplicates.near_duplicates(table(spark, folder, "documents"), percent=85)


def op6_mix_sources(spark, folder):
    drawn = mixing.mix_sizes(table(spark, folder, "documents"))
    return drawn.select(
        "doc_id", "size", "source_size", "target", (F.col("times") * F.col("size")).alias("taken"), "source", "times"
    )


def op7_token_files(spark, folder):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_files.token_digests(token_files.write_tokens(table(spark, folder, "documents"), path, end_id=2))


def op8_toxicity(spark, folder):
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    scored = toxicity.score(docs, toxicity.learn(docs, toxicity.training_labels(labels)))
    return scored.select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= toxicity.LIMIT).cast("int").alias("predicted"),
    )


def op9_html_text(spark, folder):
    return html_text.extract(table(spark, folder, "pages"))


def op11_source_divergence(spark, folder):
    return source_audit.source_divergence(table(spark, folder, "documents"), least_docs=30, first=50)


def op12_word_runs(spark, folder):
    found = word_runs.word_runs(word_runs.planted(table(spark, folder, "documents")))
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.when(F.size("runs") > 0, F.concat(F.array_join(line, "\n"), F.lit("\n"))).otherwise("")
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    best = found.select("doc_id", "runs", "collapsed", lines.alias("lines"), longest.alias("best"))
    length, start, period = F.col("best.length"), -F.col("best.col2"), -F.col("best.col3")
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), start.alias("start"), length.alias("length"),
        period.alias("period"), F.floor(length * 1000 / period).cast("long").alias("exponent_milli"),
        F.sha2(F.col("lines").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op13_shards(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    text = F.coalesce("text", F.lit(""))
    return sharding.shard_documents(docs, n_shards=16).select(
        "doc_id", sharding.text_bytes(F.col("text")).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def pipeline(spark, folder):
    return corpus_pipeline.run(spark, folder)


QUERIES = {
    "pipeline": pipeline,
    "op2_sampled_pieces": op2_sampled_pieces,
    "op4_license_scan": op4_license_scan,
    "op3_pii_pseudonyms": op3_pii_pseudonyms,
    "op1_embedding_near_dedup": op1_embedding_near_dedup,
    "op5_minhash_near_dedup": op5_minhash_near_dedup,
    "op9_html_text": op9_html_text,
    "op7_token_files": op7_token_files,
    "op8_toxicity": op8_toxicity,
    "op6_mix_sources": op6_mix_sources,
    "op10_quality_rules": op10_quality_rules,
    "op11_source_divergence": op11_source_divergence,
    "op12_word_runs": op12_word_runs,
    "op13_shards": op13_shards,
}
