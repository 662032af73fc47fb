"""From raw documents to packed training sequences: quality rules, near-dedup, PII, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelpulse.llm import minhash, packing, pii, quality
from parcelpulse.llm.common import prepare
from parcelpulse.session import staged

#: No stage that measures texts by a tokenizer, or compares them by signatures, is SQL.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    prepare(spark)
    return quality.keep_good(docs, public_tokenizers.path("piece_bpe_32k.model"))


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the least id stays."""
    prepare(spark)
    return minhash.keep_one(docs)


def pii_sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the words that disclose it are replaced; n_chars follows the text."""
    prepare(spark)
    clean = pii.sanitise(docs)
    return clean.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"])) if "n_chars" in docs.columns else clean


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens, with their ids."""
    prepare(spark)
    files = (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return packing.pack(docs, *files, public_tokenizers.PATTERN)


STAGES = [
    ("quality_rules", quality_rules),
    ("minhash_dedup", minhash_dedup),
    ("pii_sanitise", pii_sanitise),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
