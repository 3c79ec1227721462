"""The stages of a training corpus, from documents to packed sequences.

Each takes what its predecessor kept; all but the last return the columns of ``documents``. Rows with nulls in any
column, empty texts and repeated rows pass through every stage as its operator says; columns beyond those of
``documents`` are left out at the start of a stage.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallywing.llm import mixing, packing, quality, secrets, weighted_minhash
from tallywing.llm.shared import checkpointed

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def of_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go. It learns from the labels of documents still there."""
    docs = docs.select(*COLUMNS)
    return quality.good(docs, quality.learnt_from(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    return weighted_minhash.first_of_each_class(docs.select(*COLUMNS))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by their kind; every document stays."""
    return secrets.redact(docs.select(*COLUMNS))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document comes as often as the mix of sources takes it, which may be never or up to three times."""
    return mixing.mixed_documents(docs.select(*COLUMNS))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 4,096 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", of_good_quality),
    ("minhash_near_dedup", one_of_near_duplicates),
    ("secret_scans", without_secrets),
    ("mixing_sources", mixed),
    ("packing", packed),
]

#: No SQL expresses the classifier or the tokenizer; tests hold every stage against a plain version instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; what a stage keeps is written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = checkpointed(docs)
    return docs
