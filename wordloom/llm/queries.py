"""The queries of the corpus operators, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, merkle, packing, pii, quality, set_join, sharding, simhash, substring_dedup, token_alignment, token_store, url_filter, warc
from .common import table


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_filter(table(spark, sf_dir, "pages", "page_id", "url"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_paragraphs(table(spark, sf_dir, "documents", "doc_id", "text"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents", "doc_id", "text"))


def packed_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The case of operator 3 in which its limits differ: whole conversations, of which only the assistant's tokens bear loss."""
    return packing.pack_conversations(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"), packing.Limits(2048, 16, 1024))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_and_read(spark, table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents", "doc_id", "text"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))


def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.token_files(spark, table(spark, sf_dir, "documents", "doc_id", "text"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.compacted(spark, table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "lang", "source", "n_chars", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents", "doc_id", "text"))


def op11_set_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return set_join.similar_documents(table(spark, sf_dir, "documents", "doc_id", "text"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.alignment(table(spark, sf_dir, "documents", "doc_id", "text"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents", "doc_id", "source", "lang", "n_chars", "text"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = (op1_url_filter, op2_substring_dedup, op3_packing, packed_conversations, op4_warc, op5_pii, op6_decontaminate, op7_token_store, op8_sharding, op9_simhash, op10_quality, op11_set_join, op12_token_alignment, op13_merkle)
    return {f.__name__: f for f in named}


def oracle_sql() -> dict[str, str]:
    return {"op1_url_filter": url_filter.oracle(), "op4_warc": warc.oracle(), "op5_pii": pii.oracle(), "op6_decontaminate": decontaminate.oracle(), "op8_sharding": sharding.oracle(), "op11_set_join": set_join.oracle(), "op13_merkle": merkle.oracle()}
