"""A corpus from raw documents to token ids: five stages, each written as Parquet and read again by the next one.

Toxic documents go, one document of each near-duplicate group stays, passages that repeat are cut, sources are mixed to
their weights, and what is left is encoded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import mixing, pieces, simhash, suffixes, toxicity
from ledgerloom.llm.common import table
from ledgerloom.session import stage


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.clean(docs, table(spark, sf_dir, "labels"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_per_group(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of about fifty words (200 bytes) that repeat; a document that loses all its text stays as an empty one.

    A cut may fall inside a character; what is left of that character is dropped.
    """
    return suffixes.shortened(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encoded(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("simhash", without_near_copies),
    ("suffix_dedup", without_repeats),
    ("mixing", mixed),
    ("sentencepiece", encoded),
]

#: SQL cannot train or run the network of the first stage; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
