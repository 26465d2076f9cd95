"""Text rules, option rules, failure logs, gates and plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.hashing import draw
from ..operators import contracts as co
from ..operators.selection import permutation
from .registry import load, query

_STEM = """'The word "' || p_name || '" in ' || CASE p_partkey % 4 WHEN 0 THEN 'line ' || p_size WHEN 1 THEN 'paragraph ' || (p_size % 9) WHEN 2 THEN 'the third paragraph' ELSE 'the ninth paragraph' END || ' is closest in meaning to'"""


@query("""
SELECT p_partkey, CASE WHEN p_partkey % 4 < 3 THEN p_name END AS target, CASE p_partkey % 4 WHEN 0 THEN 'line' WHEN 1 THEN 'paragraph' WHEN 2 THEN 'paragraph' END AS kind,
  CASE p_partkey % 4 WHEN 0 THEN p_size WHEN 1 THEN p_size % 9 WHEN 2 THEN 3 END::BIGINT AS number FROM part""")
def stem_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a question's stem refers to and where; null where the place can't be read."""
    return load(spark, sf_dir, "part").select("p_partkey", co.stem_reference(F.expr(_STEM)).alias("r")).select("p_partkey", "r.target", "r.kind", F.col("r.number").cast("long").alias("number"))


@query(r"""
WITH b AS (SELECT item_id, text, string_split(text, ' ')[2] AS word FROM benchmark)
SELECT item_id, regexp_matches(text, '(^|[^\p{L}\p{N}_''-])' || regexp_escape(word) || '($|[^\p{L}\p{N}_''-])') AS whole,
  regexp_matches(text, '(^|[^\p{L}\p{N}_''-])' || regexp_escape(substring(word, 1, 2)) || '($|[^\p{L}\p{N}_''-])') AS part,
  len(list_filter(range(1, length(text)), lambda i: substring(text, i::INTEGER, 2) = substring(word, 1, 2)))::BIGINT AS starts FROM b WHERE length(word) > 2""")
def expression_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether an expression and a part of it stand in an item as whole words, and where the part occurs at all."""
    items = load(spark, sf_dir, "benchmark").select("item_id", "text", F.get(F.split("text", " "), F.lit(1)).alias("word")).where(F.length("word") > 2)
    part = F.substring("word", 1, 2)
    starts = F.size(tx.substring_starts(F.col("text"), part)).cast("long")
    return items.select("item_id", co.has_expression(F.col("text"), F.col("word")).alias("whole"), co.has_expression(F.col("text"), part).alias("part"), starts.alias("starts"))


_OPTIONS = "f AS (SELECT p_partkey // 4 AS item, p_partkey % 4 AS i, p_name, p_brand FROM part), w AS (SELECT item, max(p_name) FILTER (i = 0) AS a, max(p_name) FILTER (i = 1) AS b, max(p_name) FILTER (i = 2) AS c, max(p_name) FILTER (i = 3) AS d, max(p_brand) FILTER (i = 0) AS brand FROM f GROUP BY item HAVING count(*) = 4)"


def options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of four options (four parts in a row) as a map by letter, and the first part's brand; fewer parts make no item."""
    rows = load(spark, sf_dir, "part").select(F.floor(F.col("p_partkey") / 4).cast("long").alias("item"), (F.col("p_partkey") % 4).alias("i"), "p_name", "p_brand")
    four = [F.max(F.when(F.col("i") == i, F.col("p_name"))).alias(x) for i, x in enumerate("ABCD")]
    items = rows.groupBy("item").agg(*four, F.max(F.when(F.col("i") == 0, F.col("p_brand"))).alias("brand"), F.count("*").alias("n")).where("n = 4")
    return items.select("item", "brand", F.create_map(*[y for x in "ABCD" for y in (F.lit(x), F.col(x))]).alias("options"))


@query(f"""
WITH {_OPTIONS}, l AS (SELECT item, x, o FROM w, LATERAL (SELECT unnest(['A', 'B', 'C', 'D']) AS x, unnest([a, b, c, d]) AS o)),
r AS (SELECT item, x, o, row_number() OVER (PARTITION BY item ORDER BY sha256(concat_ws('|', 'permute', item::VARCHAR, x)), x) AS i FROM l)
SELECT item, max(o) FILTER (i = 1) AS "A", max(o) FILTER (i = 2) AS "B", max(o) FILTER (i = 3) AS "C", max(o) FILTER (i = 4) AS "D", ['A', 'B', 'C', 'D'][max(i) FILTER (x = 'B')] AS answer FROM r GROUP BY item""")
def permuted_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Options and answer (B before) under each item's own permutation of the letters."""
    told = options(spark, sf_dir).withColumn("order", permutation("ABCD", "permute", "item"))
    moved = co.permuted(F.col("options"), F.col("order"))
    return told.select("item", moved.alias("m"), co.moved_label(F.lit("B"), F.col("order")).alias("answer")).select("item", *[F.col("m")[x].alias(x) for x in "ABCD"], "answer")


@query(f"""
WITH {_OPTIONS}, t AS (SELECT *, lower('about ' || b || CASE WHEN substring(brand, -1) IN ('1', '2') THEN ' or ' || c ELSE '' END || ' and more') AS passage FROM w)
SELECT item, len(string_split(b, ' ')) >= 2 AND contains(passage, lower(b)) AND NOT (contains(passage, lower(a)) OR contains(passage, lower(c)) OR contains(passage, lower(d))) AS copied FROM t""")
def copied_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers (option B) of two words or more that stand in the passage while no wrong option does."""
    extra = F.when(F.substring("brand", -1, 1).isin("1", "2"), F.concat(F.lit(" or "), F.col("options")["C"])).otherwise("")
    told = options(spark, sf_dir).withColumn("passage", F.concat(F.lit("about "), F.col("options")["B"], extra, F.lit(" and more")))
    return told.select("item", co.copied_answer(F.col("options"), F.lit("B"), F.col("passage"), least=2).alias("copied"))


_LOG = "CASE event_id % 8 WHEN 0 THEN 'Unauthorized: api key' WHEN 1 THEN 'socket closed, connection reset' WHEN 2 THEN 'request timed out' WHEN 3 THEN 'Invalid JSON schema given' WHEN 4 THEN 'exit with stack trace' WHEN 5 THEN 'dns lookup' || repeat('.', 9000) ELSE '' END"
_CODE = "CASE event_id % 8 WHEN 2 THEN NULL WHEN 4 THEN 1 WHEN 5 THEN 2 WHEN 6 THEN 0 ELSE 1 END"


@query("""
SELECT event_id, CASE event_id % 8 WHEN 0 THEN 'AUTH_ERROR' WHEN 1 THEN 'NETWORK_ERROR' WHEN 2 THEN 'HARNESS_TIMEOUT' WHEN 3 THEN 'SCHEMA_COMPATIBILITY_ERROR' WHEN 4 THEN 'PROCESS_ERROR' WHEN 5 THEN 'PROCESS_ERROR' WHEN 6 THEN CASE WHEN event_type = 'error' THEN 'MODEL_OUTPUT_ERROR' ELSE 'CONTRACT_VALIDATION_ERROR' END ELSE 'SUCCESS' END AS class FROM events""")
def failure_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failed calls by category, exit code and the last 8000 characters of their logs."""
    category = F.expr("CASE WHEN event_id % 8 = 7 THEN NULL WHEN event_id % 8 = 6 AND event_type = 'error' THEN 'parsing' ELSE 'failed' END")
    return load(spark, sf_dir, "events").select("event_id", co.failure_class(category, F.expr(_LOG), F.expr(_CODE)).alias("class"))


@query("""
WITH e AS (SELECT event_id, event_type AS stage, (user_id % 20)::VARCHAR AS detail, value FROM events), r AS (SELECT stage, detail, 'process' AS category, event_id FROM e WHERE value < 20),
o AS (SELECT stage, detail, CASE WHEN event_id % 2 = 0 THEN 'schema' ELSE 'other' END AS category, event_id FROM e WHERE value > 300),
k AS (SELECT * FROM o WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.stage = o.stage AND r.detail = o.detail)), u AS (SELECT * FROM r UNION ALL SELECT stage, detail, CASE category WHEN 'schema' THEN 'CONTRACT_VALIDATION_ERROR' ELSE category END, event_id FROM k)
SELECT stage, detail, category, min(event_id) AS first_id FROM u GROUP BY ALL""")
def merged_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failures of calls, and those of outcomes that no call accounts for; each kind once, with its first."""
    events = load(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("stage"), (F.col("user_id") % 20).cast("string").alias("detail"), "value")
    calls = events.where("value < 20").select("stage", "detail", F.lit("process").alias("category"), "event_id")
    outcomes = events.where("value > 300").select("stage", "detail", F.when(F.col("event_id") % 2 == 0, "schema").otherwise("other").alias("category"), "event_id")
    return co.merge_failures(calls, outcomes, ["stage", "detail"], "event_id").withColumnRenamed("first", "first_id")


@query("""
WITH g AS (SELECT o_orderpriority AS run, avg((o_orderstatus <> 'P')::INT) > 0.9 AS reviewer, sum(o_totalprice) / count(*) > 1000 AS solver, count(*) % 2 = 0 AS logic, max(o_totalprice) > 400000 AS live, bool_or(o_orderkey % 997 = 0) AS crashed FROM orders GROUP BY ALL)
SELECT run, CASE WHEN reviewer AND solver AND logic AND live THEN 'A' WHEN NOT live AND crashed THEN 'E' WHEN NOT reviewer THEN 'B' WHEN NOT solver THEN 'C' WHEN NOT logic THEN 'D' ELSE 'E' END AS decision FROM g""")
def run_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run's decision by its groups of gates, in order of weight."""
    gates = load(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("run")).agg(
        (F.avg((F.col("o_orderstatus") != "P").cast("int")) > 0.9).alias("reviewer"), (F.sum("o_totalprice") / F.count("*") > 1000).alias("solver"),
        (F.count("*") % 2 == 0).alias("logic"), (F.max("o_totalprice") > 400000).alias("live"), F.some(F.col("o_orderkey") % 997 == 0).alias("crashed"))
    return gates.select("run", co.decision(*map(F.col, ("reviewer", "solver", "logic", "live", "crashed"))).alias("decision"))


@query("""
WITH p AS (SELECT page_id, regexp_replace(coalesce(url, ''), '^[a-z]+://', '') AS path FROM pages)
SELECT page_id, regexp_matches(path, '^[^/]*[.]com(/|$)') OR starts_with(path, 'www.') AS allowed FROM p""")
def path_allowlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths against prefixes and wildcards that are allowed."""
    path = F.regexp_replace(F.coalesce("url", F.lit("")), "^[a-z]+://", "")
    return load(spark, sf_dir, "pages").select("page_id", co.path_allowed(path, prefixes=["www."], patterns=["*.com/**", "*.com"]).alias("allowed"))


@query("""
WITH t AS (SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS s, ts FROM events)
SELECT event_id, event_id % 3 = 0 AS valid, CASE WHEN event_id % 3 = 0 THEN (event_id % 100)::DOUBLE END AS elapsed FROM t""")
def zoned_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ISO times, of which only those with a zone count, and the seconds between two of them."""
    local = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    end = F.date_format(F.expr("ts + make_interval(0, 0, 0, 0, 0, 0, event_id % 100)"), "yyyy-MM-dd'T'HH:mm:ss")
    zone = F.expr("CASE event_id % 3 WHEN 0 THEN 'Z' WHEN 1 THEN '' ELSE ' soon' END")
    a, b = F.concat(local, zone), F.concat(end, F.replace(zone, F.lit("Z"), F.lit("+00:00")))
    return load(spark, sf_dir, "events").select("event_id", co.zoned(a).isNotNull().alias("valid"), co.elapsed(a, b).alias("elapsed"))


@query("""
SELECT doc_id, n_chars IS DISTINCT FROM length(text) AS off_by_any, abs(n_chars / 1000.0 - length(text) / 1000.0) >= 0.00011 AS off FROM documents""")
def declared_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared lengths against recomputed ones, exactly and within a tolerance."""
    n = F.length("text")
    return load(spark, sf_dir, "documents").select("doc_id", (~F.col("n_chars").eqNullSafe(n)).alias("off_by_any"), co.differs(F.col("n_chars") / 1000, n / 1000).alias("off"))


@query("""
WITH s AS (SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM documents),
d AS (SELECT c_custkey, ['en', 'de', 'fr', 'es'][c_custkey % 4 + 1] AS lang FROM customer)
SELECT c_custkey, lang, doc_id FROM d JOIN s USING (lang) WHERE i = ('0x' || substring(sha256(concat_ws('|', 'observed', c_custkey::VARCHAR)), 1, 8))::BIGINT % n""")
def observed_draw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each plan an observation drawn from its own group, by hash.

    Observations are numbered in each group; a draw meets its observation by an equality join.
    """
    group = Window.partitionBy("lang")
    seen = load(spark, sf_dir, "documents").select("lang", "doc_id", (F.row_number().over(group.orderBy("doc_id")) - 1).cast("long").alias("i"))
    sizes = load(spark, sf_dir, "documents").groupBy("lang").agg(F.count("*").alias("n"))
    plans = load(spark, sf_dir, "customer").select("c_custkey", F.get(F.split(F.lit("en,de,fr,es"), ","), (F.col("c_custkey") % 4).cast("int")).alias("lang"))
    drawn = plans.join(sizes, "lang").withColumn("i", draw(F.col("n"), F.lit("observed"), "c_custkey"))
    return drawn.join(seen, ["lang", "i"]).select("c_custkey", "lang", "doc_id")


@query("""
WITH l AS (SELECT l_orderkey, count(*) AS n, count(DISTINCT l_linenumber) AS d, min(l_linenumber) AS lo, max(l_linenumber) AS hi, count(DISTINCT l_partkey) AS parts, sum(l_quantity) AS q FROM lineitem GROUP BY ALL)
SELECT o_orderkey, array_to_string(list_filter([CASE WHEN n IS NULL THEN 'no_items' END, CASE WHEN n <> d THEN 'duplicate_order' END, CASE WHEN lo <> 1 OR hi <> n THEN 'order_not_1_to_n' END, CASE WHEN parts < n THEN 'duplicate_item' END, CASE WHEN q > 200 THEN 'length_window' END], lambda x: x IS NOT NULL), ',') AS errors
FROM orders LEFT JOIN l ON l_orderkey = o_orderkey""")
def batch_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each batch (order) against its plan: its items there, numbered from 1, none twice, sizes in range."""
    batches = load(spark, sf_dir, "orders").select("o_orderkey")
    items = load(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_quantity")
    return co.batch_errors(batches, items, "o_orderkey", "l_linenumber", "l_partkey", "l_quantity", 200).select("o_orderkey", F.array_join("errors", ",").alias("errors"))


@query("""
WITH o AS (SELECT o_orderkey, o_custkey, o_orderdate FROM orders), c AS (SELECT l_orderkey, string_agg(l_linenumber || ':' || l_returnflag, ',' ORDER BY l_linenumber, l_returnflag) AS history, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT o_orderkey, c_name, coalesce(history, '') AS history, coalesce(n, 0)::BIGINT AS rounds FROM o LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN c ON l_orderkey = o_orderkey""")
def provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of several tables as one record a key, with its history in order.

    A key's history is bounded by the rounds that a lifecycle allows (seven here).
    """
    history = load(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_returnflag"))).alias("h"))
    orders = load(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    names = load(spark, sf_dir, "customer").select("c_custkey", "c_name")
    joined = orders.join(history, "o_orderkey", "left").join(names, "c_custkey", "left")
    text = F.array_join(F.transform("h", lambda s: F.concat_ws(":", s["l_linenumber"].cast("string"), s["l_returnflag"])), ",")
    return joined.select("o_orderkey", "c_name", F.coalesce(text, F.lit("")).alias("history"), F.coalesce(F.size("h"), F.lit(0)).cast("long").alias("rounds"))


@query("SELECT e.event_id, e.event_type, CASE WHEN event_type IN ('click', 'view') AND user_id % 2 = 0 OR event_type = 'error' AND user_id % 2 = 1 THEN NULL ELSE event_type || '/' || (user_id % 2) || ': not allowed' END AS error FROM events e")
def taxonomy_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of type and subtype that a small table of allowed pairs does not hold."""
    allowed = spark.createDataFrame([("click", 0), ("view", 0), ("error", 1)], "event_type string, subtype int")
    rows = load(spark, sf_dir, "events").select("event_id", "event_type", (F.col("user_id") % 2).cast("int").alias("subtype"))
    return co.not_allowed(rows, allowed, ["event_type", "subtype"]).select("event_id", "event_type", "error")
