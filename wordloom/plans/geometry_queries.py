"""Marked spans in benchmark sentences; positions are drawn from hashes of the item."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.hashing import draw
from ..operators import geometry as ge
from ..operators.selection import hash_order, top_by
from .registry import load, query

_WORDS = r"regexp_extract_all(text, '[\p{L}\p{N}]+(?:[''’\-][\p{L}\p{N}]+)*') AS w"


def _draw_sql(total: int, *parts: str) -> str:
    return f"('0x' || substring(sha256(concat_ws('|', {', '.join(parts)})), 1, 8))::BIGINT % {total}"


def sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of each item."""
    return load(spark, sf_dir, "benchmark").select("item_id", tx.lexical_tokens(F.col("text")).alias("w"))


def marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four spans of one to three words, each in a quarter of its own, some beyond the end."""
    spans, quarter = [], F.floor((F.size("w") + 7) / 4)
    for i, label in enumerate(ge.LABELS):
        start = (draw(1_000_003, F.lit(label), "item_id") % quarter + quarter * i).cast("int")
        spans.append(ge.span(F.col("w"), start, (draw(3, F.lit("size"), F.lit(label), "item_id") + 1).cast("int")))
    return sentences(spark, sf_dir).select("item_id", "w", F.array(*spans).alias("spans"))


_MARKED = f"""b AS (SELECT item_id, {_WORDS} FROM benchmark),
s AS (SELECT item_id, len(w) AS n, i, {_draw_sql(1_000_003, "label", "item_id::VARCHAR")} % ((len(w) + 7) // 4) + ((len(w) + 7) // 4) * i AS s, {_draw_sql(3, "'size'", "label", "item_id::VARCHAR")} + 1 AS size FROM b, (VALUES (0, 'A'), (1, 'B'), (2, 'C'), (3, 'D')) l(i, label)),
p AS (SELECT item_id, n, i, CASE WHEN s < n THEN s END AS s, CASE WHEN s < n THEN least(s + size, n) END AS e FROM s)"""


@query(f"""
WITH {_MARKED}, m AS (SELECT item_id, count(DISTINCT x) AS marked FROM (SELECT item_id, unnest(range(s, e)) AS x FROM p WHERE s IS NOT NULL) GROUP BY item_id),
g AS (SELECT item_id, max(n) AS n, max(e - s) AS longest, max(CASE WHEN i = 1 THEN s END) - max(CASE WHEN i = 0 THEN e END) AS g1, max(CASE WHEN i = 2 THEN s END) - max(CASE WHEN i = 1 THEN e END) AS g2, max(CASE WHEN i = 3 THEN s END) - max(CASE WHEN i = 2 THEN e END) AS g3 FROM p GROUP BY item_id)
SELECT item_id, n::BIGINT AS n_words, coalesce(marked, 0)::BIGINT AS n_marked, (n - coalesce(marked, 0))::BIGINT AS n_unmarked, round(coalesce(marked, 0)::DOUBLE / nullif(n, 0), 4) AS coverage, longest::BIGINT AS longest,
  g1::BIGINT AS "gap_AB", g2::BIGINT AS "gap_BC", g3::BIGINT AS "gap_CD", coalesce(g1 >= 0, FALSE) AND coalesce(g2 >= 0, FALSE) AND coalesce(g3 >= 0, FALSE) AS ordered FROM g LEFT JOIN m USING (item_id)""")
def span_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, coverage, gaps and order of four marked spans in each sentence."""
    told = marked(spark, sf_dir).select("item_id", ge.diagnostics(F.col("w"), F.col("spans")).alias("d"))
    whole = ["n_words", "n_marked", "n_unmarked", "longest", "gap_AB", "gap_BC", "gap_CD"]
    return told.select("item_id", *[F.col(f"d.{c}").cast("long").alias(c) for c in whole], "d.coverage", "d.ordered")


@query()
def monotone_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marked phrases found again in their sentence, from left to right.

    The fold over labels carries the last end along, which SQL has no form for; tested in plain Python.
    """
    words = F.col("w")
    phrases = [F.slice(words, s["start"] + 1, s["end"] - s["start"]) for s in (F.get("spans", F.lit(i)) for i in range(4))]
    swapped = [phrases[1], phrases[0], phrases[2], phrases[3]]
    found = [ge.spans_of(words, F.coalesce(phrase, F.array().cast("array<string>"))) for phrase in swapped]
    told = marked(spark, sf_dir).select("item_id", ge.aligned(found).alias("a"))
    return told.select("item_id", F.to_json("a.spans", {"ignoreNullFields": "false"}).alias("spans"), "a.status")


_POOL = f"""b AS (SELECT item_id, {_WORDS} FROM benchmark),
c AS (SELECT item_id, s, s + k AS e FROM (SELECT item_id, len(w) AS n, k, unnest(range(0, len(w) - k + 1)) AS s FROM b, (SELECT unnest(range(1, 5)) AS k) WHERE len(w) >= k)),
t AS (SELECT item_id, s, e, row_number() OVER (PARTITION BY item_id ORDER BY sha256(concat_ws('|', 'pool', item_id::VARCHAR, s::VARCHAR, e::VARCHAR)), s, e) AS i FROM c),
pool AS (SELECT item_id, s, e FROM t WHERE i <= 24)"""


@query(f"""
WITH {_POOL}, m AS (SELECT a.item_id, round(abs(b.s - a.e - 3.54) + abs(c.s - b.e - 3.82), 6)::DOUBLE AS score, a.s AS start1, a.e AS end1, b.s AS start2, b.e AS end2, c.s AS start3, c.e AS end3
  FROM pool a JOIN pool b ON a.item_id = b.item_id AND b.s > a.e JOIN pool c ON b.item_id = c.item_id AND c.s > b.e),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score, start1, end1, start2, end2, start3, end3) AS i FROM m)
SELECT item_id, score, start1::BIGINT AS start1, end1::BIGINT AS end1, start2::BIGINT AS start2, end2::BIGINT AS end2, start3::BIGINT AS start3, end3::BIGINT AS end3 FROM r WHERE i = 1""")
def span_set_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best three spans of each sentence out of a hash-ordered pool of 24 windows of one to four words."""
    sizes = F.explode(F.sequence(F.lit(1), F.lit(4))).alias("k")
    each = sentences(spark, sf_dir).select("item_id", "w", sizes).where(F.size("w") >= F.col("k"))
    windows = each.select("item_id", F.explode(F.sequence(F.lit(0).cast("long"), F.size("w").cast("long") - F.col("k"))).alias("start"), "k")
    spans = windows.select("item_id", "start", (F.col("start") + F.col("k")).alias("end"))
    pool = top_by(spans, ["item_id"], [hash_order("pool", "item_id", "start", "end"), F.col("start"), F.col("end")], 24).drop("rank")
    return ge.best_triples(pool, "item_id")


@query()
def stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve orders of each state, balanced over priorities and then over years.

    Each pick depends on those before it, so there is no SQL; tested in plain Python.
    """
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", F.year("o_orderdate").alias("year"))
    return ge.stratified(orders, "o_orderstatus", "o_orderpriority", "year", "o_orderkey", 12)
