"""The training-data pipeline over `documents`: five stages, each an operator of ledgerloom.llm.

A stage takes (spark, docs, sf_dir), works on every row its predecessor kept, and returns a
DataFrame that is written as Parquet and read again as the next stage's documents.
"""

import public_tokenizers
from pyspark.sql import functions as F

from ledgerloom.llm import bpe, decontamination, exact_dedup, quality, simhash
from ledgerloom.llm.common import keep, prepare, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
VOCABULARY = "byte_bpe_50k.json"


def keep_good(spark, docs, sf_dir):
    """Documents that the quality classifier accepts."""
    prepare(spark)
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark, docs, sf_dir):
    """One document of each group of equal texts."""
    prepare(spark)
    return exact_dedup.without_copies(docs)


def drop_near_copies(spark, docs, sf_dir):
    """One document of each SimHash component."""
    prepare(spark)
    return simhash.first_of_each(docs)


def drop_leaks(spark, docs, sf_dir):
    """Documents that contain no benchmark item."""
    prepare(spark)
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def encode(spark, docs, sf_dir):
    """Token ids of every document (packed little-endian unsigned 32-bit integers), with digests
    of them and of what they decode to."""
    prepare(spark)
    encoded = bpe.encoded_documents(docs.select("doc_id", "text"), public_tokenizers.path(VOCABULARY))
    return encoded.select(
        "doc_id",
        "n_tokens",
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality classifier", keep_good),
    ("exact dedup", drop_copies),
    ("simhash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_leaks),
    ("bpe encoding", encode),
]

# The quality classifier and BPE have no SQL form; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over `documents`; each result is written to the shared folder and reread."""
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
