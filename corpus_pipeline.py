"""Corpus pipeline over ``documents``: filter, deduplicate, decontaminate, mask secrets, encode.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; its result is written and read
again as the next one's docs. The first four return the columns of ``documents``.

All stages take null ids, texts, sources and langs, repeated rows, texts of any length, empty tables (they give none)
and further columns, which stay up to the last stage. Null texts count as empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from wardline.llm import bpe, decontaminate, ngram_join, quality, secret_scan
from wardline.llm.common import read, store


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go, null and empty texts among them; lines too frequent on a host are taken out of the others.

    Null sources are one host. Near copies do not reject each other; they are the next stage's.
    """
    return quality.clean(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents stays: that of the smallest doc_id, nulls last, then by a key of its text."""
    return ngram_join.one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go, with all rows of the same text; an empty benchmark takes none."""
    return decontaminate.without_leaks(docs, read(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked, and n_chars follows; null texts stay null. Overlapping ones become one mask, named by the first."""
    return secret_scan.mask(docs)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (packed unsigned 32-bit, little endian), and digests of the ids and of the text decoded from them."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.encode_decode(docs, path, keep=True).drop("decoded")


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("BPE encoding and decoding", bpe_encoding),
]

# Encoding is not expressible in SQL; tests run the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name.split(" ")[0].lower())
    return docs
