"""The corpus pipeline: quality rules, near-duplicates, secrets, source mix, sequence packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallymark.llm.common import materialised
from tallymark.llm.minhash_dedup import one_of_each
from tallymark.llm.mixing import mixed_documents
from tallymark.llm.packing import pack_documents
from tallymark.llm.quality_rules import kept_documents
from tallymark.llm.secret_scan import redacted_documents


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base checks and the rule table."""
    return kept_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every class of near duplicates: that of the least id."""
    return one_of_each(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret; n_chars follows the text."""
    return redacted_documents(docs, length_col="n_chars")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, placed in sequences of 4096 tokens."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality),
    ("minhash_dedup", near_duplicates),
    ("secret_scan", secrets),
    ("fair_mix", mix),
    ("pack_sequences", pack),
]

#: Near-duplicate classes and tokenizers are beyond SQL; the tests hold it against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialised(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
