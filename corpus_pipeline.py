"""A training-data pipeline over the table ``documents``.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps, with
their columns; it is written as Parquet and read again for the next one. The
last stage encodes what is left: doc_id, n_tokens, ids_sha256, decoded_sha256
and token_ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import bpe, decontaminate, exact_dedup, near_dedup, quality
from ledgerline.llm.storage import documents, materialise, table


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier does not reject."""
    return quality.drop_low_quality(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five words, 80 %)."""
    return near_dedup.drop_near_copies(docs, percent=80)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """BPE ids of each document, and the digest of what they decode to."""
    return bpe.encode_documents(docs, bpe.default_tokenizer(spark, "word_bpe_49k.json"), with_ids=True)


STAGES = [
    ("quality_classifier", quality_filter),
    ("exact_dedup", drop_copies),
    ("minhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_leaks),
    ("bpe_encoding", encode),
]

# a trained classifier cannot be expressed in SQL; the tests compare the
# stages with brute-force versions instead
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
