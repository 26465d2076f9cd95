"""Cohort measures over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import cohort as co
from .registry import load, query

_STATS = """count(v)::BIGINT AS n, sum(v)::BIGINT::DOUBLE / count(v)::DOUBLE AS mean, median(v)::DOUBLE AS median, min(v)::BIGINT AS least, max(v)::BIGINT AS most,
  CASE WHEN count(v) > 1 THEN sqrt((count(v)::HUGEINT * sum(v::HUGEINT * v::HUGEINT) - sum(v)::HUGEINT * sum(v)::HUGEINT)::DOUBLE / (count(v) * (count(v) - 1))::DOUBLE) WHEN count(v) = 1 THEN 0.0 END AS deviation"""


@query(f"""
WITH d AS (SELECT lang, n_chars AS v FROM documents)
SELECT 'lang' AS dimension, lang AS value, {_STATS} FROM d GROUP BY lang UNION ALL SELECT 'all', 'all', {_STATS} FROM d""")
def descriptive_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length statistics by language and over all documents."""
    docs = load(spark, sf_dir, "documents").select("lang", F.col("n_chars").alias("v"))
    return co.by_dimensions(docs, ["lang"], co.descriptive("v"))


@query("""
WITH b AS (SELECT lang, CASE WHEN n_chars <= 100 THEN '<=100' WHEN n_chars <= 500 THEN '101-500' WHEN n_chars <= 2000 THEN '501-2000' WHEN n_chars <= 10000 THEN '2001-10000' ELSE '10001+' END AS bin FROM documents),
g AS (SELECT DISTINCT lang FROM documents), l AS (SELECT unnest(['<=100', '101-500', '501-2000', '2001-10000', '10001+']) AS bin)
SELECT g.lang, l.bin, count(b.bin)::BIGINT AS n FROM g CROSS JOIN l LEFT JOIN b ON b.lang = g.lang AND b.bin = l.bin GROUP BY ALL""")
def length_histogram_zero_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lengths in fixed bins, with zeros for the empty ones."""
    edges = [(100, "<=100"), (500, "101-500"), (2000, "501-2000"), (10000, "2001-10000")]
    docs = load(spark, sf_dir, "documents").select("lang", tx.bins(F.col("n_chars"), edges, "10001+").alias("bin"))
    counts = docs.groupBy("lang", "bin").agg(F.count("*").alias("n"))
    return co.zero_filled(counts, [b for _, b in edges] + ["10001+"], "bin", docs.select("lang").distinct(), ["lang"])


_FUNNEL = "count(*)::BIGINT AS n_all, count(quality)::BIGINT AS n_rated, count(*) FILTER (quality = 1)::BIGINT AS n_good, count(*) FILTER (quality = 1 AND toxic = 0)::BIGINT AS n_accepted, (count(*) FILTER (quality = 1 AND toxic = 0))::DOUBLE / nullif(count(quality), 0) AS acceptance"


@query(f"""
WITH f AS (SELECT lang, source, quality, toxic FROM documents LEFT JOIN labels USING (doc_id))
SELECT 'lang' AS dimension, lang AS value, {_FUNNEL} FROM f GROUP BY lang UNION ALL SELECT 'source', source, {_FUNNEL} FROM f GROUP BY source UNION ALL SELECT 'all', 'all', {_FUNNEL} FROM f""")
def quality_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, rated, good and accepted, by language, by source and over all."""
    facts = load(spark, sf_dir, "documents").select("doc_id", "lang", "source").join(load(spark, sf_dir, "labels"), "doc_id", "left")
    good, rated = F.col("quality") == 1, F.count("quality")
    accepted = F.count_if(good & (F.col("toxic") == 0))
    return co.by_dimensions(facts, ["lang", "source"], [F.count("*").alias("n_all"), rated.alias("n_rated"), F.count_if(good).alias("n_good"), accepted.alias("n_accepted"), co.rate(accepted, rated).alias("acceptance")])


@query("""
WITH u AS (SELECT 'status' AS dim, o_orderstatus AS value, o_orderstatus = 'F' AS done FROM orders UNION ALL SELECT 'priority', o_orderpriority, o_orderstatus = 'F' FROM orders)
SELECT dim, value, count(*)::BIGINT AS planned, count(*) FILTER (done)::BIGINT AS accepted FROM u WHERE value IS NOT NULL GROUP BY ALL""")
def marginal_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planned and accepted counts along several dimensions at once."""
    orders = load(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"), (F.col("o_orderstatus") == "F").alias("done"))
    long = orders.unpivot("done", ["status", "priority"], "dim", "value").where("value IS NOT NULL")
    return long.groupBy("dim", "value").agg(F.count("*").alias("planned"), F.count_if("done").alias("accepted"))


@query("SELECT event_type, count(*)::BIGINT AS n_events, count(DISTINCT user_id)::BIGINT AS n_users FROM events GROUP BY event_type")
def events_vs_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events and the distinct users behind them."""
    return load(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n_events"), F.countDistinct("user_id").alias("n_users"))


@query("""
WITH m AS (SELECT count(*) AS n, count(*) FILTER (text IS NULL OR text = '') AS empty, count(DISTINCT doc_id) AS ids, count(DISTINCT lang) AS langs, count(quality) AS rated FROM documents LEFT JOIN labels USING (doc_id))
SELECT gate, observed::BIGINT AS observed, requirement, passed FROM (
  SELECT 'no_empty_text' AS gate, empty AS observed, '= 0' AS requirement, empty = 0 AS passed FROM m UNION ALL
  SELECT 'unique_ids', n - ids, '= 0', n = ids FROM m UNION ALL SELECT 'languages', langs, '>= 4', langs >= 4 FROM m UNION ALL SELECT 'rated_half', rated, '>= half', rated * 2 >= n FROM m)""")
def gate_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Named gates with what was observed and whether it is enough."""
    facts = load(spark, sf_dir, "documents").join(load(spark, sf_dir, "labels"), "doc_id", "left")
    m = facts.agg(F.count("*").alias("n"), F.count_if(F.coalesce("text", F.lit("")) == "").alias("empty"), F.countDistinct("doc_id").alias("ids"), F.countDistinct("lang").alias("langs"), F.count("quality").alias("rated"))
    c = F.col
    return co.gates(m, [("no_empty_text", c("empty"), "= 0", c("empty") == 0), ("unique_ids", c("n") - c("ids"), "= 0", c("n") == c("ids")), ("languages", c("langs"), ">= 4", c("langs") >= 4), ("rated_half", c("rated"), ">= half", c("rated") * 2 >= c("n"))])


@query("""
WITH c AS (SELECT conv_id, count(*) AS turns, count(*) FILTER (role = 'user') AS users, sum(length(text)) AS chars FROM conversations GROUP BY conv_id)
SELECT turns::BIGINT AS turns, count(*)::BIGINT AS n_conversations, sum(users)::BIGINT AS user_turns, sum(chars)::BIGINT AS chars FROM c GROUP BY turns""")
def two_phase_counter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures of each conversation, then counts over conversations."""
    each = load(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count("*").alias("turns"), F.count_if(F.col("role") == "user").alias("users"), F.sum(F.length("text")).alias("chars"))
    return each.groupBy("turns").agg(F.count("*").alias("n_conversations"), F.sum("users").alias("user_turns"), F.sum("chars").cast("long").alias("chars"))


@query("SELECT user_id, " + ", ".join(f"count(*) FILTER (event_type = '{t}')::BIGINT AS {t}" for t in ("click", "error", "purchase", "signup", "view")) + " FROM events GROUP BY user_id")
def retry_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column of counts for each kind, zeros included."""
    return load(spark, sf_dir, "events").groupBy("user_id").pivot("event_type", ["click", "error", "purchase", "signup", "view"]).count().na.fill(0)


@query("""
WITH a AS (SELECT l_suppkey, l_returnflag FROM lineitem WHERE l_linenumber = 1), b AS (SELECT l_suppkey, l_returnflag FROM lineitem WHERE l_linenumber = 2)
SELECT l_suppkey, l_returnflag, count(*)::BIGINT AS surplus FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) GROUP BY ALL""")
def multiset_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the first lines of orders have more often than the second ones."""
    lines = load(spark, sf_dir, "lineitem").where("l_linenumber IN (1, 2)")
    counts = lines.groupBy("l_suppkey", "l_returnflag").agg((F.count_if(F.col("l_linenumber") == 1) - F.count_if(F.col("l_linenumber") == 2)).alias("surplus"))
    return counts.where("surplus > 0")


@query("""
WITH u AS (SELECT 'documents' AS cohort, length(text) AS n FROM documents UNION ALL SELECT 'benchmark', length(text) FROM benchmark UNION ALL SELECT 'turns', length(text) FROM conversations)
SELECT cohort, count(*)::BIGINT AS items, min(n)::BIGINT AS least, median(n)::DOUBLE AS median, max(n)::BIGINT AS most FROM u GROUP BY cohort""")
def cohort_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same measures of several cohorts, one row each."""
    each = [load(spark, sf_dir, t).select(F.lit(c).alias("cohort"), F.length("text").alias("n")) for c, t in (("documents", "documents"), ("benchmark", "benchmark"), ("turns", "conversations"))]
    return each[0].union(each[1]).union(each[2]).groupBy("cohort").agg(F.count("n").alias("items"), F.min("n").cast("long").alias("least"), F.median("n").alias("median"), F.max("n").cast("long").alias("most"))


@query("""
WITH j AS (SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL), a AS (SELECT o_orderstatus, sum(n) AS joint FROM j GROUP BY ALL), m AS (SELECT o_orderstatus, count(*) AS marginal FROM orders GROUP BY ALL)
SELECT o_orderstatus, joint::BIGINT AS joint, marginal::BIGINT AS marginal, joint = marginal AS agree FROM a JOIN m USING (o_orderstatus)""")
def joint_and_marginal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the joint table adds up to the marginal one; both from one cube."""
    cube = load(spark, sf_dir, "orders").cube("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"), F.grouping_id().alias("g"))
    sums = cube.where("g IN (0, 1)").groupBy("o_orderstatus").agg(F.sum(F.when(F.col("g") == 0, F.col("n"))).alias("joint"), F.sum(F.when(F.col("g") == 1, F.col("n"))).alias("marginal"))
    return sums.select("*", (F.col("joint") == F.col("marginal")).alias("agree"))


@query("""
WITH r AS (SELECT p_partkey, p_brand, p_size, rank() OVER (PARTITION BY p_brand ORDER BY p_size) AS k, count(*) OVER (PARTITION BY p_brand, p_size) AS ties, count(*) OVER (PARTITION BY p_brand) AS n FROM part)
SELECT p_partkey, p_brand, (k - 1 + 0.5::DOUBLE * ties) / n::DOUBLE AS midrank FROM r""")
def midrank_percentile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mid-rank percentile of each part's size in its brand."""
    parts = load(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    return parts.join(co.midrank(parts, "p_size", "p_brand"), ["p_brand", "p_size"]).select("p_partkey", "p_brand", "midrank")


@query("""
WITH r AS (SELECT n_chars AS v FROM documents WHERE lang = 'en'), d AS (SELECT doc_id, n_chars AS v FROM documents WHERE lang = 'de'), n AS (SELECT count(*) AS n FROM r)
SELECT doc_id, ((SELECT count(*) FROM r WHERE r.v < d.v) + 0.5::DOUBLE * (SELECT count(*) FROM r WHERE r.v = d.v)) / n.n::DOUBLE AS midrank FROM d, n""")
def midrank_vs_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mid-rank of German lengths among the English ones.

    Both cohorts are counted by value; one window over the values gives the English rows below.
    """
    docs = load(spark, sf_dir, "documents").where("lang IN ('en', 'de')").select("doc_id", "lang", F.col("n_chars").alias("v"))
    ref = docs.groupBy("v").agg(F.count_if(F.col("lang") == "en").alias("ties")).withColumn("one", F.lit(1))
    ranked = co.midrank_counts(ref, "v", "one")
    return docs.where("lang = 'de'").join(ranked, "v").select("doc_id", "midrank")


_METRICS = """m AS (SELECT doc_id, lang, n_chars::DOUBLE AS chars, length(text) - length(replace(text, ' ', ''))::DOUBLE AS blanks FROM documents)"""


@query(f"""
WITH {_METRICS}, q AS (SELECT quantile_cont(chars, [0.05, 0.1, 0.9, 0.95]) AS c, quantile_cont(blanks, [0.05, 0.1, 0.9, 0.95]) AS b FROM m WHERE lang = 'en'),
r AS (SELECT doc_id, CASE WHEN chars < c[1] OR chars > c[4] THEN 2 WHEN chars < c[2] OR chars > c[3] THEN 1 ELSE 0 END AS x, CASE WHEN blanks < b[1] OR blanks > b[4] THEN 2 WHEN blanks < b[2] OR blanks > b[3] THEN 1 ELSE 0 END AS y FROM m, q)
SELECT doc_id, (['PREFERRED', 'WARNING', 'EXTREME'])[x + 1] AS chars_band, (['PREFERRED', 'WARNING', 'EXTREME'])[y + 1] AS blanks_band, (['PREFERRED', 'WARNING', 'EXTREME'])[greatest(x, y) + 1] AS worst FROM r""")
def band_and_worst_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bands of two metrics against the quantiles of the English cohort, and the worse of them."""
    docs = load(spark, sf_dir, "documents")
    blanks = (F.length("text") - F.length(F.replace("text", F.lit(" "), F.lit("")))).cast("double")
    m = docs.select("doc_id", "lang", F.col("n_chars").cast("double").alias("chars"), blanks.alias("blanks"))
    limits = m.where("lang = 'en'").agg(co.quantiles("chars").alias("c"), co.quantiles("blanks").alias("b"))  # one row
    told = m.crossJoin(F.broadcast(limits)).select("doc_id", co.band(F.col("chars"), F.col("c")).alias("chars_band"), co.band(F.col("blanks"), F.col("b")).alias("blanks_band"))
    return told.withColumn("worst", co.worst(F.array("chars_band", "blanks_band")))


@query("""
WITH m AS (SELECT doc_id, n_chars AS a, length(source) AS b, lang FROM documents),
s AS (SELECT count(*) AS n, sum(a)::BIGINT AS sa, sum(a::HUGEINT * a) AS qa, sum(b)::BIGINT AS sb, sum(b::HUGEINT * b) AS qb FROM m WHERE lang = 'en'),
d AS (SELECT n, sa::DOUBLE / n AS ma, sb::DOUBLE / n AS mb, coalesce(nullif(sqrt((n * qa - sa::HUGEINT * sa)::DOUBLE) / n, 0), 1.0) AS da, coalesce(nullif(sqrt((n * qb - sb::HUGEINT * sb)::DOUBLE) / n, 0), 1.0) AS db FROM s)
SELECT doc_id, sqrt((((a - ma) / da) * ((a - ma) / da) + ((b - mb) / db) * ((b - mb) / db)) / 2) > 1.5 AS far,
  round(sqrt((((a - ma) / da) * ((a - ma) / da) + ((b - mb) / db) * ((b - mb) / db)) / 2) * 1000)::BIGINT AS distance_milli FROM m, d""")
def rms_z_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Root mean square of z-scores against the English cohort (population deviation, 0 as 1)."""
    m = load(spark, sf_dir, "documents").select("doc_id", "lang", F.col("n_chars").alias("a"), F.length("source").cast("long").alias("b"))
    n, one = F.count("*"), []
    for c in ("a", "b"):
        total = F.sum(c)
        squares = F.sum(F.col(c).cast("decimal(38,0)") * F.col(c))
        spread = (n.cast("decimal(38,0)") * squares.cast("decimal(38,0)") - total.cast("decimal(38,0)") * total.cast("decimal(38,0)")).cast("double")
        one += [(total.cast("double") / n).alias(f"mean_{c}"), F.coalesce(F.nullif(F.sqrt(spread) / n, F.lit(0.0)), F.lit(1.0)).alias(f"dev_{c}")]
    stats = m.where("lang = 'en'").agg(*one)  # one row
    z = [(F.col(c) - F.col(f"mean_{c}")) / F.col(f"dev_{c}") for c in ("a", "b")]
    rms = F.sqrt((z[0] * z[0] + z[1] * z[1]) / 2)
    return m.crossJoin(F.broadcast(stats)).select("doc_id", (rms > 1.5).alias("far"), F.round(rms * 1000).cast("long").alias("distance_milli"))
