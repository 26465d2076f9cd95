"""Queries that need Python's text library inside tasks; each is tested against a plain version."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import udfs
from .registry import load, query


@query()
def near_duplicate_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Similarity of the four options of an item (parts in a row), pair by pair."""
    item = F.floor(F.col("p_partkey") / 4).cast("long").alias("item")
    rows = load(spark, sf_dir, "part").select(item, "p_partkey", tx.normalized(F.col("p_name")).alias("name"))
    other = rows.select("item", F.col("p_partkey").alias("other"), F.col("name").alias("name2"))
    pairs = rows.join(other, "item").where("p_partkey < other")  # six pairs an item at most
    return pairs.select("item", "p_partkey", "other", udfs.similarity("name", "name2").alias("ratio")).withColumn("near", F.col("ratio") >= 0.92)


@query()
def turn_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token edits between a turn's text and the same text with its first two words exchanged."""
    words = tx.blank_words(F.col("text"))
    turns = load(spark, sf_dir, "conversations").select("conv_id", "turn", words.alias("w")).where(F.size("w") > 2)
    moved = F.concat(F.slice("w", 2, 1), F.slice("w", 1, 1), F.slice("w", F.lit(3), F.size("w") - 2))
    told = turns.withColumn("v", moved)
    return told.select("conv_id", "turn", F.size(udfs.token_diff("w", "v")).cast("long").alias("n_edits"), udfs.one_block_moved("w", "v").alias("one_move"))


@query(r"""SELECT item_id, length(replace(lower(text), 'ß', 'ss'))::BIGINT AS n_folded, length(replace(lower(trim(regexp_replace(nfc_normalize(text), '\s+', ' ', 'g'))), 'ß', 'ss'))::BIGINT AS n_surface FROM benchmark""")
def folded_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lengths of the casefolded text and of the option surface."""
    b = load(spark, sf_dir, "benchmark")
    return b.select("item_id", F.length(udfs.casefold("text")).cast("long").alias("n_folded"), F.length(udfs.nfkc_surface("text")).cast("long").alias("n_surface"))


@query()
def wrapped_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items as numbered lines of at most 72 columns."""
    lines = load(spark, sf_dir, "benchmark").select("item_id", F.posexplode(udfs.display_lines("text")).alias("i", "line"))
    return lines.select("item_id", (F.col("i") + 1).cast("long").alias("number"), "line")
