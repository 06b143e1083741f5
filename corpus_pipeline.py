"""From documents to packed training sequences: five stages, each written before the next.

Language ID drops texts without a language, near-dedup keeps one document of each class,
the secret scan masks credentials, mixing takes every source to its target, packing cuts the
token ids into sequences of 1024.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mostrador.llm import language, mixing, neardup, packing, secrets
from mostrador.llm.common import Scratch


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language; null texts and those without a letter go."""
    return language.in_a_language(docs)


def one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal and nearly equal texts the document with the smallest id."""
    return neardup.deduplicated(docs).select([F.col(f"`{c}`") for c in docs.columns])


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its secrets masked."""
    return secrets.redact(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, each as often as it takes them."""
    return mixing.mixed(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 1024 ids, with their ids."""
    return packing.pack(docs, keep=["doc_id", "lang", "source"], with_ids=True)


STAGES = [
    ("language ID", known_language),
    ("MinHash near-dedup", one_of_each_class),
    ("secret scans", without_secrets),
    ("mixing sources to target weights", mixed_sources),
    ("packing", packed),
]

# No SQL for trained models, sampled signatures and tokenizers: the tests hold each stage
# against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every stage's result is written and read again by the next."""
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = scratch.stored(stage(spark, docs, sf_dir), f"stage{number}")
    return docs
