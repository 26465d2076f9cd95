"""Corpus preparation: from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir), works on every row its predecessor kept, and is written
as Parquet and read again before the next one. All stages but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wordloom.llm import decontaminate, packing, pii, quality, simhash
from wordloom.llm.common import new_dir, table


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates.

    Candidates meet in buckets of MinHash bands, as fingerprints alone can't reach a similarity of
    0.8; wide SimHash fingerprints and pivots thin them, exact shingle similarity decides.
    """
    return simhash.keep_first(docs)


def decontam(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked."""
    return pii.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 2048 tokens."""
    return packing.pack_documents(docs)


STAGES = [("quality_rules", rules), ("simhash_near_dedup", near_dedup), ("decontamination", decontam), ("pii", private), ("packing", pack)]
#: SimHash and tokenizer ids are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``; what is between them lies in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    folder = new_dir(spark, "pipeline")
    for n, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{n}-{name}")
            docs = spark.read.parquet(f"{folder}/{n}-{name}")
    return docs
