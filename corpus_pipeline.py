"""From raw documents to sampled token ids: filter, deduplicate, pseudonymise, mix, encode.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's docs. All but the last return the
columns of documents.
"""

from pyspark.sql import functions as F

from trolley.llm.common import stored, table
from trolley.llm.mixing import mix_documents
from trolley.llm.near_duplicates import drop_near_duplicates
from trolley.llm.pieces import encode
from trolley.llm.pii import pseudonymise
from trolley.llm.toxicity import reject_toxic


def toxicity(spark, docs, sf_dir):
    """Documents that the classifier does not reject."""
    return reject_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark, docs, sf_dir):
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8)."""
    return drop_near_duplicates(docs, percent=80)


def pii(spark, docs, sf_dir):
    """Texts with personal data replaced; n_chars follows the text."""
    return pseudonymise(docs).withColumn("n_chars", F.length("text").cast("long"))


def mixing(spark, docs, sf_dir):
    """Documents as often as the mix takes them."""
    return mix_documents(docs)


def sampled_pieces(spark, docs, sf_dir):
    """doc_id, lang, source and the sampled piece ids of every document."""
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    return encode(docs.select("doc_id", "lang", "source", "text"), path).drop("text")


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("pii", pii),
    ("mixing", mixing),
    ("sampled_pieces", sampled_pieces),
]

# The classifier and the sampled segmentations have no SQL form.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages on the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
