"""Registered queries of this package, and the SQL that checks those which SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import fertility, html_crf, kneser_ney, langid, merkle, mixing, negatives, pieces, sharding, simhash, sql, suffixes, toxicity, vafile
from ledgerloom.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vafile.top_k(table(spark, sf_dir, "embeddings"))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(table(spark, sf_dir, "documents"))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.judged(table(spark, sf_dir, "documents"))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_crf.extracted(table(spark, sf_dir, "pages"))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoded(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffixes.cut_repeats(docs).select("doc.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified(table(spark, sf_dir, "documents"))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identified(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {
        "op1_mixing": op1,
        "op2_va_file": op2,
        "op3_extendible_hashing": op3,
        "op4_toxicity": op4,
        "op5_kneser_ney": op5,
        "op6_fertility": op6,
        "op7_simhash": op7,
        "op8_html_crf": op8,
        "op9_sentencepiece": op9,
        "op10_suffix_dedup": op10,
        "op11_hard_negatives": op11,
        "op12_merkle": op12,
        "op13_language": op13,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_mixing": sql.MIX,
        "op2_va_file": sql.TOP_K,
        "op3_extendible_hashing": sql.shards(sharding.SHARD_BYTES),
        "op11_hard_negatives": sql.NEGATIVES,
        "op12_merkle": sql.merkle(),
    }
