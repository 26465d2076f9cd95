"""Ordered and seeded selection over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.hashing import draw
from ..operators import selection as se
from .registry import load, query


@query("""
SELECT user_id, min_by(event_type, (ts, event_id)) AS first_type, max_by(event_type, (ts, event_id)) AS last_type, count(*)::BIGINT AS n FROM events GROUP BY user_id""")
def first_last_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First and last event of each user; a partial aggregate, so no sort."""
    order = F.struct("ts", "event_id")
    return load(spark, sf_dir, "events").groupBy("user_id").agg(F.min_by("event_type", order).alias("first_type"), F.max_by("event_type", order).alias("last_type"), F.count("*").alias("n"))


@query("""
WITH e AS (SELECT user_id, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
f AS (SELECT user_id, event_type AS first_type FROM e WHERE i = 1)
SELECT f.user_id, bool_or(e.event_type = 'purchase') AS repaired FROM f JOIN e USING (user_id) WHERE f.first_type = 'error' AND e.i > 1 GROUP BY f.user_id""")
def repair_effectiveness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of users whose first event was an error, those who purchased later."""
    i = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    events = load(spark, sf_dir, "events").select("user_id", "event_type", i.alias("i"))
    first = F.max(F.when(F.col("i") == 1, F.col("event_type")))
    later = F.max(F.when(F.col("i") > 1, F.col("event_type") == "purchase"))
    return events.groupBy("user_id").agg(first.alias("f"), later.alias("repaired")).where("f = 'error' AND repaired IS NOT NULL").select("user_id", "repaired")


@query("SELECT conv_id, turn, role, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn)::BIGINT AS ordinal FROM conversations")
def running_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The how-manieth turn of its role a turn is."""
    n = F.row_number().over(Window.partitionBy("conv_id", "role").orderBy("turn"))
    return load(spark, sf_dir, "conversations").select("conv_id", "turn", "role", n.cast("long").alias("ordinal"))


@query("""
WITH h AS (SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY sha256(concat_ws('|', 'seed-7', l_orderkey::VARCHAR, l_linenumber::VARCHAR, l_partkey::VARCHAR)), l_linenumber) AS rank FROM lineitem)
SELECT l_orderkey, l_linenumber, rank::BIGINT AS rank FROM h WHERE rank <= 3""")
def hash_priority_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three lines of each order, in the order of a seeded hash."""
    lines = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    order = [se.hash_order("seed-7", "l_orderkey", "l_linenumber", "l_partkey"), F.col("l_linenumber")]
    return se.top_by(lines, ["l_orderkey"], order, 3).select("l_orderkey", "l_linenumber", F.col("rank").cast("long").alias("rank"))


_RANK = "CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'P' THEN 1 ELSE 0 END"


@query(f"SELECT o_custkey, o_orderkey FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY {_RANK} DESC, o_orderkey) AS i FROM orders) WHERE i = 1")
def best_by_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's best order by a fixed rank of states, then by key."""
    best = F.max_by("o_orderkey", F.struct(F.expr(_RANK), -F.col("o_orderkey")))
    return load(spark, sf_dir, "orders").groupBy("o_custkey").agg(best.alias("o_orderkey"))


@query("""
WITH g AS (SELECT user_id, event_id, epoch_us(ts) AS t, lead(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS u FROM events)
SELECT user_id, event_id, (u - t)::BIGINT AS gap_us, u < t AS out_of_order FROM g WHERE u IS NOT NULL""")
def adjacent_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time from each event to the user's next one."""
    t = F.unix_micros(F.col("ts").cast("timestamp"))
    events = load(spark, sf_dir, "events").select("user_id", "event_id", "ts", t.alias("t"))
    after = F.lead("t").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    told = events.withColumn("u", after).where("u IS NOT NULL")
    return told.select("user_id", "event_id", (F.col("u") - F.col("t")).alias("gap_us"), (F.col("u") < F.col("t")).alias("out_of_order"))


@query("""
WITH o AS (SELECT user_id, event_type, event_id, value, 0 AS src FROM events WHERE event_id % 3 = 0), a AS (SELECT user_id, event_type, event_id, value, 1 AS src FROM events WHERE event_id % 3 <> 0),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY src DESC, event_id DESC) AS i FROM (SELECT * FROM o UNION ALL SELECT * FROM a))
SELECT user_id, event_type, event_id, value FROM r WHERE i = 1""")
def latest_wins_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A keyed table after an upsert in which arrivals win and the latest of them counts."""
    events = load(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value")
    return se.latest_wins(events.where("event_id % 3 = 0"), events.where("event_id % 3 <> 0"), ["user_id", "event_type"], "event_id")


_DAYS = "date_diff('day', TIMESTAMP '1990-01-01', o_orderdate)"


@query(f"""
WITH i AS (SELECT o_custkey, o_orderkey, {_DAYS} AS s, {_DAYS} + 20 + o_orderkey % 30 AS e FROM orders)
SELECT a.o_custkey, a.o_orderkey AS "left", b.o_orderkey AS "right" FROM i a JOIN i b ON a.o_custkey = b.o_custkey AND a.o_orderkey < b.o_orderkey AND a.s < b.e AND b.s < a.e""")
def interval_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of a customer whose open intervals overlap."""
    day = F.datediff("o_orderdate", F.lit("1990-01-01").cast("date")).cast("long")
    orders = load(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", day.alias("s"), (day + 20 + F.col("o_orderkey") % 30).alias("e"))
    return se.overlapping(orders, "o_custkey", "s", "e", "o_orderkey", 50)


@query("""
WITH l AS (SELECT l_orderkey, min(l_shipdate) AS a, max(l_shipdate) AS b FROM lineitem GROUP BY ALL)
SELECT o_orderkey, o_orderdate <= a AND b <= o_orderdate + INTERVAL 120 DAY AS inside FROM orders JOIN l ON l_orderkey = o_orderkey""")
def interval_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether an order's shipping span lies inside its window."""
    spans = load(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min("l_shipdate").alias("a"), F.max("l_shipdate").alias("b"))
    joined = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate").join(spans, "o_orderkey")
    return joined.select("o_orderkey", F.expr("o_orderdate <= a AND b <= o_orderdate + INTERVAL 120 DAY").alias("inside"))


@query("""
WITH p AS (SELECT DISTINCT l_orderkey, unnest(range(l_linenumber::BIGINT, l_linenumber + 1 + l_partkey % 4)) AS i FROM lineitem) SELECT l_orderkey, count(*)::BIGINT AS covered FROM p GROUP BY ALL""")
def distinct_interval_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct positions that the spans of an order cover."""
    start = F.col("l_linenumber").cast("long")
    span = F.struct(start.alias("start"), (start + 1 + F.col("l_partkey") % 4).alias("end"))
    spans = load(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_set(span).alias("spans"))
    return spans.select("l_orderkey", se.covered(F.col("spans")).cast("long").alias("covered"))


def _draw_sql(total: str, *parts: str) -> str:
    return f"('0x' || substring(sha256(concat_ws('|', {', '.join(parts)})), 1, 8))::BIGINT % {total}"


@query(f"""
WITH w AS (SELECT n_name, (sum(n_regionkey + 1) OVER (ORDER BY n_name) - n_regionkey - 1)::BIGINT AS lo, (n_regionkey + 1)::BIGINT AS w FROM nation), t AS (SELECT sum(w)::BIGINT AS total FROM w),
d AS (SELECT c_custkey, {_draw_sql('total', "'nation'", 'c_custkey::VARCHAR')} AS pos FROM customer, t)
SELECT c_custkey, n_name FROM d JOIN w ON pos >= lo AND pos < lo + w""")
def weighted_choice_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A nation for each customer, by weight, from a hash of the key."""
    weights = load(spark, sf_dir, "nation").select("n_name", (F.col("n_regionkey") + 1).cast("long").alias("w"))
    draws = load(spark, sf_dir, "customer").select("c_custkey", F.lit("nation").alias("salt"))
    return se.weighted_choice(draws, weights, "n_name", "w", "salt", "c_custkey").select("c_custkey", "n_name")


@query(f"""
WITH r AS (SELECT c_custkey, {_draw_sql('5', "'region'", 'c_custkey::VARCHAR')} AS r FROM customer),
n AS (SELECT n_regionkey, n_name, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_name) - 1 AS i, count(*) OVER (PARTITION BY n_regionkey) AS k FROM nation)
SELECT c_custkey, r AS region, n_name FROM r JOIN n ON n_regionkey = r AND i = {_draw_sql('k', "'within'", 'c_custkey::VARCHAR')}""")
def joint_then_conditional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A region first, then a nation within it."""
    group = Window.partitionBy("n_regionkey")
    nations = load(spark, sf_dir, "nation").select(F.col("n_regionkey").cast("long").alias("region"), "n_name", (F.row_number().over(group.orderBy("n_name")) - 1).alias("i"), F.count("*").over(group).alias("k"))
    drawn = load(spark, sf_dir, "customer").select("c_custkey", draw(5, F.lit("region"), "c_custkey").alias("region"))
    met = drawn.join(nations, "region").where(F.col("i") == draw(F.col("k"), F.lit("within"), "c_custkey"))
    return met.select("c_custkey", "region", "n_name")


@query("""
WITH l AS (SELECT item_id, x FROM benchmark, (SELECT unnest(['A', 'B', 'C', 'D']) AS x))
SELECT item_id, string_agg(x, '' ORDER BY sha256(concat_ws('|', 'options', item_id::VARCHAR, x)), x) AS permuted FROM l GROUP BY item_id""")
def seeded_permutation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The letters of each item in its own fixed order."""
    return load(spark, sf_dir, "benchmark").select("item_id", F.array_join(se.permutation("ABCD", "options", "item_id"), "").alias("permuted"))


@query("""
WITH t AS (SELECT doc_id, lang, n_chars, CASE WHEN n_chars BETWEEN 500 AND 2000 THEN 0 WHEN n_chars > 10000 THEN 1 ELSE 2 END AS tier FROM documents)
SELECT lang, doc_id, tier, i::BIGINT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY tier, sha256(concat_ws('|', 'sample', doc_id::VARCHAR))) AS i FROM t) WHERE i <= 8""")
def quota_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight documents a language: usual lengths first, then the extremes, then the rest."""
    tier = F.expr("CASE WHEN n_chars BETWEEN 500 AND 2000 THEN 0 WHEN n_chars > 10000 THEN 1 ELSE 2 END")
    docs = load(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return se.quota(docs, "lang", tier, [se.hash_order("sample", "doc_id")], 8).select("lang", "doc_id", "tier", F.col("rank").cast("long").alias("rank"))


@query("SELECT doc_id, n_chars FROM documents ORDER BY abs(n_chars - 2000) DESC, doc_id LIMIT 10")
def most_distant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report of the ten documents farthest from the usual length."""
    return load(spark, sf_dir, "documents").select("doc_id", "n_chars").orderBy(F.abs(F.col("n_chars") - 2000).desc(), "doc_id").limit(10)


@query(f"""
SELECT item_id, {_draw_sql('4', "'balanced'", 'item_id::VARCHAR')} AS drawn, (row_number() OVER (ORDER BY sha256(concat_ws('|', 'balanced', item_id::VARCHAR))) - 1) % 4 AS position FROM benchmark""")
def balanced_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answer positions in equal shares, dealt along a hash order of the items."""
    items = se.numbered(load(spark, sf_dir, "benchmark").select("item_id"), se.hash_order("balanced", "item_id"), "i")
    return items.select("item_id", draw(4, F.lit("balanced"), "item_id").alias("drawn"), (F.col("i") % 4).cast("long").alias("position"))
