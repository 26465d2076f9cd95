"""Runs and their records: contracts, stored states, manifests, assemblies, histories and orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.hashing import sha256, table_digest
from ..operators.selection import top_by
from .registry import load, query


def errors(*rules) -> Column:
    """The names of the rules that are broken, in the order given, joined by commas."""
    return F.array_join(F.array_compact(F.array(*[F.when(broken, name) for name, broken in rules])), ",")


def errors_sql(*rules: tuple[str, str]) -> str:
    return f"array_to_string(list_filter([{', '.join(f'''CASE WHEN {broken} THEN '{name}' END''' for name, broken in rules)}], lambda x: x IS NOT NULL), ',')"


_PASSAGE = errors_sql(("too_short", "length(text) < 100"), ("below_minimum", "n < 160"), ("above_band", "n > 300"), ("paragraphs", "p NOT BETWEEN 1 AND 8"), ("declared_length", "n_chars IS DISTINCT FROM length(text)"), ("language", "lang NOT IN ('en', 'de', 'fr', 'es')"))


@query(rf"""
WITH d AS (SELECT doc_id, text, n_chars, lang, len(regexp_extract_all(text, '[\p{{L}}\p{{N}}_]+(?:[''\-][\p{{L}}\p{{N}}_]+)*')) AS n, len(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: x <> '')) AS p FROM documents)
SELECT doc_id, {_PASSAGE} AS errors FROM d""")
def passage_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each passage against its contract: length, words, paragraphs, declared length, language."""
    docs = load(spark, sf_dir, "documents").withColumn("n", F.regexp_count("text", F.lit(tx.WORDISH))).withColumn("p", F.size(tx.paragraphs(F.col("text"), "\n")))
    rules = [("too_short", F.length("text") < 100), ("below_minimum", F.col("n") < tx.WORDS_LEAST), ("above_band", F.col("n") > tx.WORDS_MOST), ("paragraphs", ~F.col("p").between(1, 8)), ("declared_length", ~F.col("n_chars").eqNullSafe(F.length("text"))), ("language", ~F.col("lang").isin("en", "de", "fr", "es"))]
    return docs.select("doc_id", errors(*rules).alias("errors"))


_ASKED = "CASE p_partkey % 5 WHEN 0 THEN 'VOCABULARY' WHEN 1 THEN 'REFERENCE' WHEN 2 THEN 'DETAIL' WHEN 3 THEN 'VOCABULARY' ELSE 'MAIN_IDEA' END"
_TARGET = "CASE WHEN p_partkey % 5 < 2 OR p_partkey % 10 = 2 THEN p_name END"
_LINE = "CASE WHEN p_partkey % 3 > 0 THEN p_size END"
_LINE_TEXT = "CASE WHEN p_partkey % 2 = 0 THEN 'about ' || p_name || ' and more' ELSE 'about ' || p_type END"


@query(f"""
WITH q AS (SELECT p_partkey, {_ASKED} AS kind, {_TARGET} AS target, {_LINE} AS line, {_LINE_TEXT} AS t FROM part), k AS (SELECT *, kind IN ('VOCABULARY', 'REFERENCE') AS needs FROM q)
SELECT p_partkey, {errors_sql(("target_missing", "needs AND target IS NULL"), ("line_missing", "needs AND line IS NULL"), ("target_unexpected", "NOT needs AND target IS NOT NULL"), ("line_out_of_range", "line NOT BETWEEN 1 AND 45"), ("target_not_in_line", "needs AND line IS NOT NULL AND target IS NOT NULL AND NOT contains(t, target)"))} AS errors FROM k""")
def target_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions that must name a target and its line, and those that must not."""
    asked = load(spark, sf_dir, "part").select("p_partkey", *[F.expr(e).alias(n) for e, n in ((_ASKED, "kind"), (_TARGET, "target"), (_LINE, "line"), (_LINE_TEXT, "t"))])
    needs, target, line = F.col("kind").isin("VOCABULARY", "REFERENCE"), F.col("target"), F.col("line")
    rules = [("target_missing", needs & target.isNull()), ("line_missing", needs & line.isNull()), ("target_unexpected", ~needs & target.isNotNull()), ("line_out_of_range", ~line.between(1, 45)), ("target_not_in_line", needs & line.isNotNull() & target.isNotNull() & ~F.contains("t", target))]
    return asked.select("p_partkey", errors(*rules).alias("errors"))


@query(f"""
WITH h AS (SELECT l_orderkey AS k, count(*) AS rounds, right(max(l_linenumber || l_linestatus), 1) AS last, count(*) - count(DISTINCT l_linenumber) AS doubled FROM lineitem GROUP BY 1)
SELECT o_orderkey, {errors_sql(("no_history", "rounds IS NULL"), ("unknown_state", "o_orderstatus NOT IN ('F', 'O', 'P')"), ("history_ends_elsewhere", "o_orderstatus <> 'P' AND last <> o_orderstatus"), ("repeated_round", "doubled > 0"), ("too_many_rounds", "rounds > 6"), ("negative_total", "o_totalprice < 0"))} AS errors,
  CASE WHEN rounds IS NULL OR doubled > 0 THEN 'refused' ELSE 'loaded' END AS status FROM orders LEFT JOIN h ON k = o_orderkey""")
def loaded_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored states with their histories: invariants, and which states are refused."""
    lines = load(spark, sf_dir, "lineitem")
    last = F.right(F.max(F.concat(F.col("l_linenumber").cast("string"), "l_linestatus")), F.lit(1)).alias("last")  # seven rounds at most
    history = lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("rounds"), last, (F.count("*") - F.count_distinct("l_linenumber")).alias("doubled"))
    states = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice").join(history, "o_orderkey", "left")
    state, rounds, doubled = F.col("o_orderstatus"), F.col("rounds"), F.col("doubled")
    rules = [("no_history", rounds.isNull()), ("unknown_state", ~state.isin("F", "O", "P")), ("history_ends_elsewhere", (state != "P") & (F.col("last") != state)), ("repeated_round", doubled > 0), ("too_many_rounds", rounds > 6), ("negative_total", F.col("o_totalprice") < 0)]
    return states.select("o_orderkey", errors(*rules).alias("errors"), F.when(rounds.isNull() | (doubled > 0), "refused").otherwise("loaded").alias("status"))


def _state_sql(rows: str) -> str:
    return f"SELECT k, sha256(concat_ws('|', count(*)::VARCHAR, sum(n)::VARCHAR)) AS digest FROM (SELECT l_orderkey AS k, ('0x' || substring(sha256(concat_ws('|', l_linenumber::VARCHAR, l_partkey::VARCHAR, l_returnflag)), 1, 15))::BIGINT AS n FROM {rows}) GROUP BY k"


@query(f"""
WITH now AS ({_state_sql("lineitem")}), bound AS ({_state_sql("(SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-06-01')")})
SELECT k AS o_orderkey, CASE WHEN b.digest IS NULL THEN 'unbound' WHEN b.digest = n.digest THEN 'current' ELSE 'stale' END AS status FROM now n LEFT JOIN bound b USING (k)""")
def stale_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches that were derived from an earlier state: refused as stale where the state's fingerprint has changed since."""

    def state(lines: DataFrame, name: str) -> DataFrame:
        rows = lines.select(F.col("l_orderkey").alias("o_orderkey"), sha256("l_linenumber", "l_partkey", "l_returnflag").alias("d"))
        return rows.groupBy("o_orderkey").agg(table_digest(F.col("d")).alias(name))

    lines = load(spark, sf_dir, "lineitem")
    both = state(lines, "now").join(state(lines.where("l_shipdate < TIMESTAMP_NTZ '1998-06-01'"), "bound"), "o_orderkey", "left")
    status = F.when(F.col("bound").isNull(), "unbound").when(F.col("bound") == F.col("now"), "current").otherwise("stale")
    return both.select("o_orderkey", status.alias("status"))


@query("""
WITH f AS (SELECT s_suppkey AS k, s_name AS name, sha256(concat_ws('|', s_name, s_nationkey::VARCHAR)) AS h FROM supplier WHERE s_acctbal > -500), n AS (SELECT s_suppkey AS k, s_name AS name, sha256(concat_ws('|', s_name, (CASE WHEN s_acctbal > 9000 THEN s_nationkey + 1 ELSE s_nationkey END)::VARCHAR)) AS h FROM supplier WHERE s_acctbal < 9500)
SELECT coalesce(f.name, n.name) AS name, CASE WHEN n.k IS NULL THEN 'missing' WHEN f.k IS NULL THEN 'added' WHEN f.h <> n.h THEN 'changed' ELSE 'same' END AS drift FROM f FULL JOIN n ON f.k = n.k""")
def manifest_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A frozen manifest of hashes against what is there now: missing, added, changed or the same."""
    s = load(spark, sf_dir, "supplier")
    frozen = s.where("s_acctbal > -500").select("s_suppkey", "s_name", sha256("s_name", "s_nationkey").alias("h"))
    moved = F.when(F.col("s_acctbal") > 9000, F.col("s_nationkey") + 1).otherwise(F.col("s_nationkey"))
    now = s.where("s_acctbal < 9500").select("s_suppkey", F.col("s_name").alias("name"), sha256("s_name", moved).alias("own"))
    both = frozen.join(now, "s_suppkey", "full")
    drift = F.when(F.col("own").isNull(), "missing").when(F.col("h").isNull(), "added").when(F.col("h") != F.col("own"), "changed").otherwise("same")
    return both.select(F.coalesce("s_name", "name").alias("name"), drift.alias("drift"))


@query("""
WITH l AS (SELECT l_orderkey, string_agg(l_linenumber || ':' || coalesce(p_name, '?') || ':' || coalesce(s_name, '?'), ';' ORDER BY l_linenumber, l_partkey, l_suppkey) AS items, count(*) AS n FROM lineitem LEFT JOIN part ON p_partkey = l_partkey LEFT JOIN supplier ON s_suppkey = l_suppkey GROUP BY l_orderkey)
SELECT o_orderkey, c_name, n_name, r_name, coalesce(items, '') AS items, coalesce(n, 0)::BIGINT AS n_items FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey LEFT JOIN l ON l_orderkey = o_orderkey""")
def assembled_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of seven tables as one record a key, its parts in order; an order has seven lines at most."""
    lines = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("p_partkey"), F.col("l_suppkey").alias("s_suppkey"))
    named = lines.join(load(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_partkey", "left").join(load(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), "s_suppkey", "left")
    nested = named.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "p_partkey", "s_suppkey", "p_name", "s_name"))).alias("i"))
    orders = load(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    people = load(spark, sf_dir, "customer").select("c_custkey", "c_name", F.col("c_nationkey").alias("n_nationkey"))
    places = load(spark, sf_dir, "nation").select("n_nationkey", "n_name", F.col("n_regionkey").alias("r_regionkey")).join(load(spark, sf_dir, "region"), "r_regionkey", "left")
    joined = orders.join(people, "c_custkey", "left").join(places, "n_nationkey", "left").join(nested, "o_orderkey", "left")
    items = F.array_join(F.transform("i", lambda x: F.concat_ws(":", x["l_linenumber"].cast("string"), F.coalesce(x["p_name"], F.lit("?")), F.coalesce(x["s_name"], F.lit("?")))), ";")
    return joined.select("o_orderkey", "c_name", "n_name", "r_name", F.coalesce(items, F.lit("")).alias("items"), F.coalesce(F.size("i"), F.lit(0)).cast("long").alias("n_items"))


@query("""
SELECT d.doc_id, coalesce(l.quality, -1)::BIGINT AS quality, coalesce(l.toxic, -1)::BIGINT AS toxic, coalesce(b.item_id, -1)::BIGINT AS item_id, (l.doc_id IS NULL)::INT::BIGINT + (b.item_id IS NULL)::INT::BIGINT AS missing
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id LEFT JOIN benchmark b ON b.item_id = d.doc_id WHERE d.n_chars > 200""")
def repair_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a repair needs from three tables, with fills where a side is missing, and how many are."""
    docs = load(spark, sf_dir, "documents").where("n_chars > 200").select("doc_id")
    labels = load(spark, sf_dir, "labels").select("doc_id", "quality", "toxic", F.lit(1).alias("l"))
    items = load(spark, sf_dir, "benchmark").select(F.col("item_id").alias("doc_id"), "item_id")
    met = docs.join(labels, "doc_id", "left").join(items, "doc_id", "left")
    missing = F.col("l").isNull().cast("long") + F.col("item_id").isNull().cast("long")
    return met.select("doc_id", *[F.coalesce(c, F.lit(-1)).cast("long").alias(c) for c in ("quality", "toxic", "item_id")], missing.alias("missing"))


@query("""
WITH p AS (SELECT c_custkey, 1 + c_custkey % 12 AS planned FROM customer), s AS (SELECT o_custkey, count(*) AS seen FROM orders GROUP BY o_custkey)
SELECT c_custkey, planned::BIGINT AS planned, seen::BIGINT AS seen, (seen - planned)::BIGINT AS difference FROM p JOIN s ON o_custkey = c_custkey""")
def plan_and_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planned against observed counts; plans that nothing was observed for are skipped."""
    plans = load(spark, sf_dir, "customer").select("c_custkey", (F.col("c_custkey") % 12 + 1).cast("long").alias("planned"))
    seen = load(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("seen"))
    return plans.join(seen, "c_custkey").select("c_custkey", "planned", "seen", (F.col("seen") - F.col("planned")).alias("difference"))


@query("""
SELECT l_partkey, n AS place, l_orderkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_returnflag = 'R', l_linestatus, l_discount DESC, l_shipdate, l_orderkey, l_linenumber, l_suppkey) AS n FROM lineitem) WHERE n <= 3""")
def evidence_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first three pieces of evidence of each part along six keys and a last one that breaks ties."""
    order = [F.col("l_returnflag") == "R", F.col("l_linestatus"), F.col("l_discount").desc(), F.col("l_shipdate"), F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_suppkey")]
    best = top_by(load(spark, sf_dir, "lineitem"), ["l_partkey"], order, 3)
    return best.select("l_partkey", F.col("rank").cast("long").alias("place"), "l_orderkey", "l_linenumber")


@query("""
WITH h AS (SELECT user_id, event_id, event_type, dayofyear(ts) % 3 AS round FROM events), m AS (SELECT user_id, round, max(event_id) AS event_id FROM h GROUP BY ALL)
SELECT user_id, round::BIGINT AS round, event_id, event_type FROM m JOIN h USING (user_id, round, event_id) WHERE event_type IN ('error', 'purchase')""")
def latest_routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest entry of each user and round, kept only where it was routed; an earlier routed one doesn't count."""
    history = load(spark, sf_dir, "events").select("user_id", "event_id", "event_type", (F.dayofyear("ts") % 3).cast("long").alias("round"))
    last = history.groupBy("user_id", "round").agg(F.max("event_id").alias("event_id"), F.max_by("event_type", "event_id").alias("event_type"))
    return last.where(F.col("event_type").isin("error", "purchase")).select("user_id", "round", "event_id", "event_type")


@query("""
WITH s AS (SELECT user_id % 8 AS shard, count(*) AS n, count(DISTINCT event_id) AS ids, min(value) AS least FROM events GROUP BY 1), ok AS (SELECT bool_and(n = ids AND least >= 0) AND count(*) = 8 AS whole FROM s)
SELECT shard::BIGINT AS shard, n::BIGINT AS n, coalesce(sum(n) OVER (ORDER BY shard ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start, whole FROM s, ok""")
def ordered_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each shard starts when eight are put in order, and whether all are there and sound; else none may be used."""
    shards = load(spark, sf_dir, "events").groupBy((F.col("user_id") % 8).cast("long").alias("shard")).agg(F.count("*").alias("n"), F.count_distinct("event_id").alias("ids"), F.min("value").alias("least"))
    every = Window.orderBy("shard")  # eight rows
    whole = F.every((F.col("n") == F.col("ids")) & (F.col("least") >= 0)).over(Window.partitionBy()) & (F.count("*").over(Window.partitionBy()) == 8)
    start = F.coalesce(F.sum("n").over(every.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long")
    return shards.select("shard", "n", start.alias("start"), whole.alias("whole"))


@query("""
SELECT doc_id, lang, n_chars FROM (SELECT *, row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) AS i FROM documents) WHERE i = 1""")
def first_occurrences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first document of each text, by digest; the texts themselves are not shuffled."""
    rows = load(spark, sf_dir, "documents").select(F.sha2("text", 256).alias("d"), "doc_id", "lang", "n_chars")
    first = rows.groupBy("d").agg(F.min("doc_id").alias("doc_id"), *[F.min_by(c, "doc_id").alias(c) for c in ("lang", "n_chars")])
    return first.select("doc_id", "lang", "n_chars")


_ORDER = ("purchase", "signup", "click", "view", "error")


@query(f"""
WITH u AS (SELECT user_id, list_distinct(list(event_type)) AS seen FROM events GROUP BY user_id)
SELECT user_id, array_to_string(list_filter([{', '.join(f"'{x}'" for x in _ORDER)}], lambda x: list_contains(seen, x)), ',') AS kinds, array_to_string(list_filter([{', '.join(f"'{x}'" for x in _ORDER)}], lambda x: NOT list_contains(seen, x)), ',') AS missing FROM u""")
def ordered_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which of a fixed list of kinds each user has, in the order of the list, and which not."""
    every = F.array(*map(F.lit, _ORDER))
    seen = load(spark, sf_dir, "events").groupBy("user_id").agg(F.collect_set("event_type").alias("s"))  # five kinds
    return seen.select("user_id", F.array_join(F.filter(every, lambda x: F.array_contains("s", x)), ",").alias("kinds"), F.array_join(F.array_except(every, "s"), ",").alias("missing"))


@query("""
WITH f AS (SELECT doc_id, 'toxic' AS flag FROM labels WHERE toxic = 1 UNION ALL SELECT doc_id, 'poor' FROM labels WHERE quality = 0 UNION ALL SELECT doc_id, 'short' FROM documents WHERE n_chars < 100 UNION ALL SELECT doc_id, 'copy' FROM (SELECT doc_id, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS i FROM documents) WHERE i > 1)
SELECT doc_id, string_agg(DISTINCT flag, ',' ORDER BY flag) AS flags FROM f GROUP BY doc_id""")
def repair_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that any of four checks flags, once each, with their flags."""
    labels, docs = load(spark, sf_dir, "labels"), load(spark, sf_dir, "documents")
    digests = docs.select("doc_id", F.sha2("text", 256).alias("d"))
    copies = digests.join(digests.groupBy("d").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1"), "d").where("doc_id <> first")
    parts = [(labels.where("toxic = 1"), "toxic"), (labels.where("quality = 0"), "poor"), (docs.where("n_chars < 100"), "short"), (copies, "copy")]
    flagged = parts[0][0].select("doc_id", F.lit(parts[0][1]).alias("flag"))
    for rows, flag in parts[1:]:
        flagged = flagged.union(rows.select("doc_id", F.lit(flag)))
    return flagged.groupBy("doc_id").agg(F.array_join(F.array_sort(F.collect_set("flag")), ",").alias("flags"))


@query("""
WITH m AS (SELECT source, n_chars, count(*) OVER (PARTITION BY source) AS n FROM documents)
SELECT source, count(*)::BIGINT AS n, round(avg(n_chars), 4) AS mean, median(n_chars)::DOUBLE AS median, count(*) FILTER (n_chars <= 100)::BIGINT AS low_tail, count(*) FILTER (n_chars > 5000)::BIGINT AS high_tail,
  round(100.0 * count(*) FILTER (n_chars > 5000) / count(*), 2)::DOUBLE AS high_percent FROM m GROUP BY source""")
def cohort_tails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size, centre and both tails of each cohort."""
    n, high = F.col("n_chars"), F.count_if(F.col("n_chars") > 5000)
    told = load(spark, sf_dir, "documents").groupBy("source").agg(
        F.count("*").alias("n"), F.round(F.avg(n), 4).alias("mean"), F.median(n).alias("median"), F.count_if(n <= 100).alias("low_tail"), high.alias("high_tail"), F.round(100.0 * high / F.count("*"), 2).alias("high_percent"))
    return told


@query("""
WITH f AS (SELECT user_id, arg_min(event_type, event_id) AS first, arg_max(event_type, event_id) AS last, min(event_id) AS a, max(event_id) AS b FROM events GROUP BY user_id)
SELECT user_id, first, last FROM f WHERE first IN ('view', 'click') AND last IN ('error', 'signup') AND a < b""")
def false_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that passed first and failed at last."""
    ends = load(spark, sf_dir, "events").groupBy("user_id").agg(F.min_by("event_type", "event_id").alias("first"), F.max_by("event_type", "event_id").alias("last"), F.min("event_id").alias("a"), F.max("event_id").alias("b"))
    return ends.where("first IN ('view', 'click') AND last IN ('error', 'signup') AND a < b").select("user_id", "first", "last")


@query(r"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents), n AS (SELECT doc_id, lower(trim(regexp_replace(line, '\s+', ' ', 'g'))) AS line FROM l), c AS (SELECT doc_id, line, count(*) AS n FROM n WHERE line <> '' GROUP BY ALL)
SELECT doc_id, count(*) FILTER (n > 1)::BIGINT AS repeated, max(n)::BIGINT AS most, sum(n)::BIGINT AS lines FROM c GROUP BY doc_id""")
def repeated_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that are the same after normalization inside one document."""
    lines = load(spark, sf_dir, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line")).select("doc_id", tx.normalized(F.col("line")).alias("line")).where("line <> ''")
    counted = lines.groupBy("doc_id", F.xxhash64("line").alias("h"), F.md5("line").alias("d")).agg(F.count("*").alias("n"))
    return counted.groupBy("doc_id").agg(F.count_if(F.col("n") > 1).alias("repeated"), F.max("n").alias("most"), F.sum("n").alias("lines"))


@query("""
WITH w AS (SELECT o_orderpriority AS a, o_orderstatus AS b, count(*) AS n FROM orders GROUP BY ALL), t AS (SELECT *, sum(n) OVER () AS total, sum(n) OVER (PARTITION BY a) AS ma FROM w)
SELECT a AS priority, b AS status, n::BIGINT AS n, round(n / total, 6)::DOUBLE AS joint, round(n / ma, 6)::DOUBLE AS conditional FROM t""")
def weight_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Joint and conditional weights of two dimensions from nested counts, flattened."""
    counts = load(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("n"))
    nested = counts.groupBy("priority").agg(F.map_from_entries(F.collect_list(F.struct("status", "n"))).alias("weights"))  # three states
    flat = nested.select("priority", F.explode("weights").alias("status", "n"))
    margins = flat.groupBy("priority").agg(F.sum("n").alias("m"))
    total = flat.agg(F.sum("n").alias("t"))  # one row
    told = flat.join(margins, "priority").crossJoin(F.broadcast(total))
    return told.select("priority", "status", "n", F.round(F.col("n") / F.col("t"), 6).alias("joint"), F.round(F.col("n") / F.col("m"), 6).alias("conditional"))


_STAGES = ("click", "error", "purchase", "signup", "view", "reviewer")
_NAME = "CASE WHEN value < 30 THEN event_type WHEN value < 60 THEN 'pilot_' || event_type WHEN value < 90 THEN 'live_pilot_' || event_type ELSE event_type || '_x' END"


@query(f"""
WITH n AS (SELECT {_NAME} AS name FROM events), s AS (SELECT unnest([{", ".join(f"'{x}'" for x in _STAGES)}]) AS stage)
SELECT stage, (SELECT count(*) FROM n WHERE name = stage)::BIGINT AS exact, (SELECT count(*) FROM n WHERE string_split(name, '_')[-1] = stage)::BIGINT AS by_suffix FROM s""")
def stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of each known stage by its exact name, and by what stands after the last underscore; stages that nothing names have zeros."""
    names = load(spark, sf_dir, "events").groupBy(F.expr(_NAME).alias("name")).agg(F.count("*").alias("n"))
    suffix = F.substring_index("name", "_", -1)
    told = names.select(F.explode(F.array(F.struct(F.col("name").alias("stage"), F.col("n").alias("exact"), F.lit(0).alias("by_suffix")), F.struct(suffix.alias("stage"), F.lit(0).alias("exact"), F.col("n").alias("by_suffix")))).alias("x"))
    sums = told.groupBy("x.stage").agg(F.sum("x.exact").alias("exact"), F.sum("x.by_suffix").alias("by_suffix"))
    known = spark.createDataFrame([(x,) for x in _STAGES], "stage string")
    return F.broadcast(known).join(sums, "stage", "left").select("stage", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("exact", "by_suffix")])


@query("""
SELECT doc_id, CASE WHEN n_chars IS NULL OR n_chars <> length(text) THEN length(text) ELSE n_chars END::BIGINT AS n_chars, coalesce(n_chars <> length(text), TRUE) AS overwritten FROM documents""")
def computed_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared lengths, overwritten by computed ones only where they differ."""
    own = F.length("text").cast("long")
    wrong = F.coalesce(F.col("n_chars") != own, F.lit(True))
    return load(spark, sf_dir, "documents").select("doc_id", F.when(wrong, own).otherwise(F.col("n_chars")).cast("long").alias("n_chars"), wrong.alias("overwritten"))
