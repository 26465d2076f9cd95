"""Judgments by key. Orders stand in for items; three raters are derived from fixed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import raters as ra
from .registry import load, query

_RATED = {
    "generator": "CASE o_orderkey % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'C' ELSE 'D' END",
    "reviewer": "CASE WHEN o_custkey % 5 = 0 THEN NULL WHEN o_custkey % 5 < 4 THEN CASE o_orderkey % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'C' ELSE 'D' END ELSE 'A' END",
    "solver": "CASE WHEN o_custkey % 11 = 0 THEN 'NONE' WHEN o_custkey % 13 = 0 THEN 'AMBIGUOUS' WHEN o_custkey % 7 = 0 THEN NULL WHEN o_custkey % 3 < 2 THEN CASE o_orderkey % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'C' ELSE 'D' END ELSE 'B' END",
    "verdict": "CASE o_orderstatus WHEN 'F' THEN 'PASS' WHEN 'O' THEN 'PASS' ELSE 'REVISE' END",
    "critical": "CASE WHEN o_orderkey % 17 = 0 THEN TRUE WHEN o_orderkey % 19 = 0 THEN NULL ELSE FALSE END",
    "ambiguous": "o_custkey % 13 = 0",
    "confidence": "CASE WHEN o_orderpriority LIKE '1%' THEN 'LOW' WHEN o_orderpriority LIKE '2%' THEN 'MEDIUM' ELSE 'HIGH' END",
    "risk": "CASE WHEN o_orderkey % 23 = 0 THEN 'HIGH' WHEN o_orderkey % 29 = 0 THEN NULL ELSE 'LOW' END",
}
_ITEMS = "items AS (SELECT o_orderkey AS item_id, " + ", ".join(f"{e} AS {n}" for n, e in _RATED.items()) + " FROM orders)"


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("item_id"), *[F.expr(e).alias(n) for n, e in _RATED.items()])


@query(f"WITH {_ITEMS} SELECT item_id, solver IS NOT DISTINCT FROM generator AS agree FROM items")
def rater_agreement2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two raters agree, two missing answers included."""
    return items(spark, sf_dir).select("item_id", ra.agree2(F.col("solver"), F.col("generator")).alias("agree"))


@query(f"WITH {_ITEMS} SELECT item_id, generator IS NOT DISTINCT FROM reviewer AND generator IS NOT DISTINCT FROM solver AS agree FROM items")
def rater_agreement3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three raters gave one answer."""
    return items(spark, sf_dir).select("item_id", ra.agree_all(F.col("generator"), F.col("reviewer"), F.col("solver")).alias("agree"))


_FAILED = """list_filter([CASE WHEN verdict IS DISTINCT FROM 'PASS' THEN 'verdict' END, CASE WHEN critical IS DISTINCT FROM FALSE THEN 'critical_failure' END,
  CASE WHEN reviewer IS DISTINCT FROM generator THEN 'reviewer_answer' END, CASE WHEN coalesce(solver IN ('A', 'B', 'C', 'D'), FALSE) = FALSE THEN 'solver_letter' END,
  CASE WHEN solver IS DISTINCT FROM generator THEN 'solver_answer' END, CASE WHEN solver IS DISTINCT FROM reviewer THEN 'solver_reviewer' END,
  CASE WHEN ambiguous IS DISTINCT FROM FALSE THEN 'ambiguity' END, CASE WHEN coalesce(confidence IN ('HIGH'), FALSE) = FALSE THEN 'confidence' END, CASE WHEN risk = 'HIGH' THEN 'similarity' END], lambda x: x IS NOT NULL)"""
_CONSENSUS = f"""WITH {_ITEMS}, f AS (SELECT *, {_FAILED} AS failed FROM items),
o AS (SELECT *, list_filter([CASE WHEN list_contains(failed, 'solver_answer') THEN 'solver_generator_mismatch' END, CASE WHEN list_contains(failed, 'solver_reviewer') THEN 'solver_reviewer_mismatch' END,
  CASE WHEN list_contains(failed, 'confidence') THEN 'solver_confidence_low' END, CASE WHEN list_contains(failed, 'similarity') THEN 'source_similarity_high' END,
  CASE WHEN list_contains(failed, 'reviewer_answer') THEN 'reviewer_generator_mismatch' END, CASE WHEN list_contains(failed, 'critical_failure') OR list_contains(failed, 'verdict') THEN 'reviewer_state_inconsistent' END], lambda x: x IS NOT NULL) AS other FROM f),
r AS (SELECT item_id, failed, CASE WHEN len(failed) = 0 THEN 'ACCEPTED' WHEN solver = 'NONE' THEN 'DISCARDED' ELSE 'MANUAL_REVIEW' END AS routing,
  CASE WHEN len(failed) = 0 THEN '' WHEN solver = 'AMBIGUOUS' THEN 'solver_ambiguous' WHEN solver = 'NONE' THEN 'solver_none' WHEN len(other) = 0 THEN 'unspecified_condition_failure' ELSE array_to_string(other, ',') END AS disagreement FROM o)"""


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("generator", "verdict", "critical", "reviewer", "solver", "ambiguous", "confidence", "risk")
    return items(spark, sf_dir).withColumn("c", ra.consensus(*map(F.col, names)))


@query(f"{_CONSENSUS} SELECT item_id, array_to_string(failed, ',') AS failed, routing, disagreement FROM r")
def consensus_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nine conditions for acceptance, the route of an item, and why it was not accepted."""
    return judged(spark, sf_dir).select("item_id", F.array_join("c.failed", ",").alias("failed"), "c.routing", F.array_join("c.disagreement", ",").alias("disagreement"))


@query(f"{_CONSENSUS}, e AS (SELECT item_id, unnest(failed) AS reason FROM r) SELECT reason, count(*)::BIGINT AS n_items FROM e GROUP BY reason")
def failure_taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items by failed condition."""
    return judged(spark, sf_dir).select(F.explode("c.failed").alias("reason")).groupBy("reason").agg(F.count("*").alias("n_items"))


@query(f"{_CONSENSUS} SELECT item_id, coalesce(list_filter(['similarity', 'critical_failure', 'solver_letter', 'solver_answer'], lambda p: list_contains(failed, p))[1], failed[1]) AS first_reason, array_to_string(list_filter(failed, lambda x: x <> coalesce(list_filter(['similarity', 'critical_failure', 'solver_letter', 'solver_answer'], lambda p: list_contains(failed, p))[1], failed[1])), ',') AS others FROM r WHERE len(failed) > 0")
def primary_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first failed condition in a fixed order of weight, and the rest."""
    failed = F.col("c.failed")
    heavy = F.filter(F.array(*map(F.lit, ("similarity", "critical_failure", "solver_letter", "solver_answer"))), lambda p: F.array_contains(failed, p))
    first = F.coalesce(F.get(heavy, F.lit(0)), F.get(failed, F.lit(0)))
    told = judged(spark, sf_dir).where(F.size(failed) > 0).withColumn("first_reason", first)
    return told.select("item_id", "first_reason", F.array_join(F.filter(failed, lambda x: x != F.col("first_reason")), ",").alias("others"))


@query("""
WITH l AS (SELECT l_orderkey, count(*) AS n, sum(l_quantity) AS q FROM lineitem GROUP BY ALL)
SELECT o_orderkey, array_to_string(list_filter([CASE WHEN c_custkey IS NULL THEN 'no_customer' END, CASE WHEN c_acctbal < 0 THEN 'overdrawn' END, CASE WHEN n IS NULL THEN 'no_lines' END, CASE WHEN q > 150 THEN 'too_many' END, CASE WHEN o_orderstatus <> 'F' THEN 'open' END], lambda x: x IS NOT NULL), ',') AS reasons
FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN l ON o_orderkey = l_orderkey""")
def per_item_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Left joins of three tables by key and the reasons against each item."""
    lines = load(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"), F.sum("l_quantity").alias("q"))
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    customers = load(spark, sf_dir, "customer").select(F.col("c_custkey"), "c_acctbal")
    joined = orders.join(lines, "o_orderkey", "left").join(customers, orders["o_custkey"] == customers["c_custkey"], "left")
    c = F.col
    why = ra.reasons((c("c_custkey").isNull(), "no_customer"), (c("c_acctbal") < 0, "overdrawn"), (c("n").isNull(), "no_lines"), (c("q") > 150, "too_many"), (c("o_orderstatus") != "F", "open"))
    return joined.select("o_orderkey", F.array_join(why, ",").alias("reasons"))


@query("""
WITH e AS (SELECT DISTINCT o_orderkey AS k FROM orders), s AS (SELECT DISTINCT l_orderkey AS k FROM lineitem)
SELECT k, CASE WHEN s.k IS NULL THEN 'missing' ELSE 'unexpected' END AS side FROM e FULL JOIN s USING (k) WHERE e.k IS NULL OR s.k IS NULL""")
def missing_and_unexpected_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders without lines, and lines without an order."""
    expected = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"))
    supplied = load(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"))
    return ra.id_sets(expected, supplied, "k")


_EDITED = "SELECT n_nationkey, CASE WHEN n_nationkey % 7 = 0 THEN lower(n_name) ELSE n_name END AS n_name, CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE n_regionkey END AS n_regionkey FROM nation WHERE n_nationkey <> 3"


@query(f"""
WITH now AS ({_EDITED})
SELECT n.n_nationkey, CASE WHEN w.n_nationkey IS NULL THEN '(absent)' ELSE array_to_string(list_filter([CASE WHEN n.n_name IS DISTINCT FROM w.n_name THEN 'n_name' END, CASE WHEN n.n_regionkey IS DISTINCT FROM w.n_regionkey THEN 'n_regionkey' END], lambda x: x IS NOT NULL), ',') END AS changed
FROM nation n LEFT JOIN now w ON n.n_nationkey = w.n_nationkey WHERE w.n_nationkey IS NULL OR n.n_name IS DISTINCT FROM w.n_name OR n.n_regionkey IS DISTINCT FROM w.n_regionkey""")
def snapshot_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What has changed since a snapshot was recorded."""
    nation = load(spark, sf_dir, "nation")
    now = nation.where("n_nationkey <> 3").select("n_nationkey", F.expr("CASE WHEN n_nationkey % 7 = 0 THEN lower(n_name) ELSE n_name END AS n_name"), F.expr("CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE n_regionkey END AS n_regionkey"))
    return ra.drift(nation, now, ["n_nationkey"], ["n_name", "n_regionkey"]).select("n_nationkey", F.array_join("changed", ",").alias("changed"))


@query(f"""
WITH b AS ({_EDITED} UNION ALL SELECT 99, 'NOWHERE', 0)
SELECT n_nationkey, array_to_string(list_filter([CASE WHEN a.n_name IS NULL THEN '(not in artifact)' END, CASE WHEN b.n_name IS NULL THEN '(invented)' END,
  CASE WHEN a.n_name IS NOT NULL AND b.n_name IS NOT NULL AND a.n_name <> b.n_name THEN 'n_name' END, CASE WHEN a.n_name IS NOT NULL AND b.n_name IS NOT NULL AND a.n_regionkey IS DISTINCT FROM b.n_regionkey THEN 'n_regionkey' END], lambda x: x IS NOT NULL), ',') AS faults
FROM nation a FULL JOIN b USING (n_nationkey) WHERE a.n_name IS DISTINCT FROM b.n_name OR a.n_regionkey IS DISTINCT FROM b.n_regionkey""")
def replay_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored artifact against its recomputation, both ways."""
    nation = load(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    again = nation.where("n_nationkey <> 3").select("n_nationkey", F.expr("CASE WHEN n_nationkey % 7 = 0 THEN lower(n_name) ELSE n_name END AS n_name"), F.expr("CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE n_regionkey END AS n_regionkey"))
    again = again.union(spark.range(1).select(F.lit(99), F.lit("NOWHERE"), F.lit(0)))
    return ra.replay(nation, again, ["n_nationkey"], ["n_name", "n_regionkey"]).select("n_nationkey", F.array_join("faults", ",").alias("faults"))


@query("""
WITH r AS (SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'R' THEN 'REVISE' WHEN 'A' THEN 'PASS' ELSE CASE WHEN l_linestatus = 'O' THEN 'PASS' ELSE 'REJECT' END END AS verdict FROM lineitem),
n AS (SELECT *, count(*) FILTER (verdict = 'REVISE') OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, verdict ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS revisions FROM r)
SELECT l_orderkey, l_linenumber, CASE verdict WHEN 'PASS' THEN 'SOLVING' WHEN 'REJECT' THEN 'REJECTED' ELSE CASE WHEN coalesce(revisions, 0) < 2 THEN 'REVISE_REQUIRED' ELSE 'DISCARDED' END END AS route FROM n""")
def verdict_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each review's route, with a limit on revisions before it."""
    from pyspark.sql import Window

    verdict = F.expr("CASE l_returnflag WHEN 'R' THEN 'REVISE' WHEN 'A' THEN 'PASS' ELSE CASE WHEN l_linestatus = 'O' THEN 'PASS' ELSE 'REJECT' END END")
    lines = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", verdict.alias("verdict"))
    before = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "verdict").rowsBetween(Window.unboundedPreceding, -1)
    revisions = F.coalesce(F.count_if(F.col("verdict") == "REVISE").over(before), F.lit(0))
    return lines.select("l_orderkey", "l_linenumber", ra.route_verdict(F.col("verdict"), revisions).alias("route"))
