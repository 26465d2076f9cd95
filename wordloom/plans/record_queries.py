"""Records between stages: projections, migrations, identity, evidence, rater output and their rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.hashing import canonical, sha256
from ..operators.selection import hash_order, top_by
from ..sources import file_tree as files
from ..sources.records import markdown
from ..sources.storage import fresh_folder
from .registry import load, query
from .run_queries import errors, errors_sql


@query("""
WITH t AS (SELECT conv_id, list(turn ORDER BY turn, text) FILTER (role = 'assistant') AS turns, list(length(text) ORDER BY turn, text) FILTER (role = 'assistant') AS sizes FROM conversations GROUP BY conv_id)
SELECT conv_id, coalesce(array_to_string(list_transform(range(1, len(turns) + 1), lambda i: (turns[i] + 1)::VARCHAR || ':' || sizes[i]::VARCHAR), ','), '') AS shown FROM t""")
def filtered_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each conversation the assistant's turns only, with their number from 1 and length.

    A conversation's turns are bounded by the dialogue's length.
    """
    turns = load(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text", "role"))).alias("t"))
    shown = F.transform(F.filter("t", lambda x: x["role"] == "assistant"), lambda x: F.concat_ws(":", (x["turn"] + 1).cast("string"), F.length(x["text"]).cast("string")))
    return turns.select("conv_id", F.array_join(shown, ",").alias("shown"))


@query("""
SELECT d.doc_id, coalesce(l.quality::VARCHAR, d.lang) AS value, CASE WHEN l.quality IS NOT NULL THEN 'label' ELSE 'fallback' END AS origin FROM documents d LEFT JOIN labels l USING (doc_id)""")
def candidate_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A value for each candidate, from another column where the first source has none."""
    both = load(spark, sf_dir, "documents").select("doc_id", "lang").join(load(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    value = F.coalesce(F.col("quality").cast("string"), "lang")
    return both.select("doc_id", value.alias("value"), F.when(F.col("quality").isNotNull(), "label").otherwise("fallback").alias("origin"))


@query("""
SELECT p_partkey, split_part(p_type, ' ', 1) AS slot, p_size AS target, CASE WHEN p_retailprice > 1500 THEN 'too dear: ' || p_name WHEN p_size > 40 THEN 'too large: ' || p_size END AS feedback FROM part""")
def slot_feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a slot asks for, and what its generator is told; null where nothing is to be said."""
    feedback = F.when(F.col("p_retailprice") > 1500, F.concat(F.lit("too dear: "), "p_name")).when(F.col("p_size") > 40, F.concat(F.lit("too large: "), F.col("p_size").cast("string")))
    return load(spark, sf_dir, "part").select("p_partkey", F.split_part("p_type", F.lit(" "), F.lit(1)).alias("slot"), F.col("p_size").alias("target"), feedback.alias("feedback"))


_LEGACY = """CASE event_id % 4 WHEN 0 THEN '{"id":' || event_id || ',"reason":"' || event_type || '"}' WHEN 1 THEN '{"entry_id":' || event_id || ',"routing":"' || event_type || '","version":2}' WHEN 2 THEN '{"reason":"' || event_type || '"}' ELSE 'not json' END"""


@query(f"""
WITH e AS (SELECT event_id, {_LEGACY} AS j FROM events), v AS (SELECT event_id, CASE WHEN json_valid(j) THEN j::JSON END AS j FROM e),
m AS (SELECT event_id, coalesce(json_extract_string(j, '$.entry_id'), json_extract_string(j, '$.id')) AS id, coalesce(json_extract_string(j, '$.routing'), json_extract_string(j, '$.reason'), 'UNKNOWN') AS routing, coalesce(json_extract_string(j, '$.version'), '1') AS version FROM v)
SELECT event_id, id::BIGINT AS entry_id, CASE WHEN id IS NOT NULL THEN routing END AS routing, CASE WHEN id IS NOT NULL THEN version::INT::BIGINT END AS version, CASE WHEN id IS NULL THEN 'rejected' WHEN version = '2' THEN 'current' ELSE 'migrated' END AS outcome FROM m""")
def migrated_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of an old and a new layout in the new one, with defaults; those without an id are rejected."""
    j = F.from_json(F.expr(_LEGACY), "id long, entry_id long, reason string, routing string, version long")
    told = load(spark, sf_dir, "events").select("event_id", j.alias("j"))
    entry, version = F.coalesce("j.entry_id", "j.id"), F.coalesce(F.col("j.version"), F.lit(1))
    routing = F.coalesce(F.col("j.routing"), F.col("j.reason"), F.lit("UNKNOWN"))
    outcome = F.when(entry.isNull(), "rejected").when(version == 2, "current").otherwise("migrated")
    return told.select("event_id", entry.alias("entry_id"), F.when(entry.isNotNull(), routing).alias("routing"), F.when(entry.isNotNull(), version).alias("version"), outcome.alias("outcome"))


@query("""
WITH d AS (SELECT doc_id, text FROM documents)
SELECT doc_id, len(list_filter(list_transform(string_split_regex(trim(replace(text, chr(10), chr(10) || ' ' || chr(10))), chr(10) || '[ \t]*' || chr(10)), lambda p: trim(p)), lambda p: p <> ''))::BIGINT AS paragraphs FROM d""")
def blank_line_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs split at blank lines, after each line break has been made one."""
    spaced = F.replace("text", F.lit("\n"), F.lit("\n \n"))
    return load(spark, sf_dir, "documents").select("doc_id", F.size(tx.paragraphs(spaced)).cast("long").alias("paragraphs"))


@query("""
WITH m AS (SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'items[' || (event_id % 7) || '].' || event_type || ': must be one of ' || user_id WHEN 1 THEN '$.' || event_type || ': required' ELSE event_type END AS message FROM events),
s AS (SELECT event_id, regexp_replace(split_part(message, ':', 1), '\\[[0-9]+\\]', '[]', 'g') AS signature FROM m)
SELECT signature, count(*)::BIGINT AS n, min(event_id) AS first_id FROM s GROUP BY signature""".replace("\\\\", "\\"))
def error_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validation messages by what they are about, without positions and details."""
    message = F.expr("CASE event_id % 3 WHEN 0 THEN 'items[' || (event_id % 7) || '].' || event_type || ': must be one of ' || user_id WHEN 1 THEN '$.' || event_type || ': required' ELSE event_type END")
    signature = F.regexp_replace(F.substring_index(message, ":", 1), r"\[[0-9]+\]", "[]")
    return load(spark, sf_dir, "events").select("event_id", signature.alias("signature")).groupBy("signature").agg(F.count("*").alias("n"), F.min("event_id").alias("first_id"))


@query("""
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'final' WHEN 'P' THEN 'manual_review' ELSE 'open' END AS output, (SELECT count(*) FROM orders WHERE o_orderstatus = 'O') > 0 AS refused FROM orders""")
def finalized_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which output each state goes to; while any state is open, finalization is refused as a whole."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    open_ = orders.agg((F.count_if(F.col("o_orderstatus") == "O") > 0).alias("refused"))  # one row
    output = F.when(F.col("o_orderstatus") == "F", "final").when(F.col("o_orderstatus") == "P", "manual_review").otherwise("open")
    return orders.crossJoin(F.broadcast(open_)).select("o_orderkey", output.alias("output"), "refused")


@query("""
WITH f AS (SELECT l_orderkey, count(*) AS n, count(*) FILTER (l_returnflag = 'A') AS ok, count(*) FILTER (l_returnflag = 'R') AS bad, count(*) FILTER (l_linestatus = 'O') AS open FROM lineitem GROUP BY l_orderkey)
SELECT o_orderkey, CASE WHEN n IS NULL THEN 'NO_EVIDENCE' WHEN open > 0 THEN 'INCOMPLETE' WHEN bad = 0 THEN 'PRODUCED' WHEN bad < ok THEN 'PARTIAL' ELSE 'REFUSED' END AS decision, coalesce(n, 0)::BIGINT AS items, coalesce(ok, 0)::BIGINT AS accepted FROM orders LEFT JOIN f ON l_orderkey = o_orderkey""")
def evidence_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What becomes of a run, from the flags of its items."""
    flags = load(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count("*").alias("n"), F.count_if(F.col("l_returnflag") == "A").alias("ok"), F.count_if(F.col("l_returnflag") == "R").alias("bad"), F.count_if(F.col("l_linestatus") == "O").alias("open"))
    told = load(spark, sf_dir, "orders").select("o_orderkey").join(flags, "o_orderkey", "left")
    decision = F.when(F.col("n").isNull(), "NO_EVIDENCE").when(F.col("open") > 0, "INCOMPLETE").when(F.col("bad") == 0, "PRODUCED").when(F.col("bad") < F.col("ok"), "PARTIAL").otherwise("REFUSED")
    return told.select("o_orderkey", decision.alias("decision"), F.coalesce("n", F.lit(0)).alias("items"), F.coalesce("ok", F.lit(0)).alias("accepted"))


_LOWER = r"regexp_extract_all(lower(text), '[\p{L}\p{N}]+(?:[''’\-][\p{L}\p{N}]+)*')"


@query(rf"""
WITH b AS (SELECT item_id, {_LOWER} AS w FROM benchmark), p AS (SELECT item_id, w, w[3:4] AS phrase FROM b WHERE len(w) >= 4),
s AS (SELECT item_id, list_filter(range(0, len(w) - 1), lambda i: w[i + 1:i + 2] = phrase) AS places FROM p)
SELECT item_id, len(places)::BIGINT AS n, (CASE WHEN len(places) = 1 THEN places[1] END)::BIGINT AS start, len(places) > 0 AS contained, CASE len(places) WHEN 0 THEN 'not_found' WHEN 1 THEN 'unique' ELSE 'repeated' END AS status FROM s""")
def span_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each item's third and fourth word stand in a row, whatever their case, and whether only once."""
    words = load(spark, sf_dir, "benchmark").select("item_id", tx.found(F.lower("text"), tx.LEXICAL).alias("w")).where(F.size("w") >= 4)
    told = words.select("item_id", tx.occurrences(F.col("w"), F.slice("w", 3, 2)).alias("at"))
    n = F.size("at")
    status = F.when(n == 0, "not_found").when(n == 1, "unique").otherwise("repeated")
    return told.select("item_id", n.cast("long").alias("n"), F.when(n == 1, F.get("at", F.lit(0))).cast("long").alias("start"), (n > 0).alias("contained"), status.alias("status"))


_STOP = ", ".join(f"'{w}'" for w in tx.STOPWORDS)


def _content(column: str) -> str:
    return f"list_distinct(list_filter(list_transform(regexp_extract_all({column}, '[A-Za-z]+(?:''[A-Za-z]+)?'), lambda w: lower(w)), lambda w: length(w) > 2 AND w NOT IN ({_STOP})))"


@query(f"""
WITH t AS (SELECT conv_id, turn, role, text, lag(text) OVER (PARTITION BY conv_id ORDER BY turn, text) AS before FROM conversations), c AS (SELECT conv_id, turn, role, {_content("text")} AS a, {_content("coalesce(before, '')")} AS e FROM t)
SELECT conv_id, turn, CASE WHEN role <> 'system' AND turn % 5 <> 4 AND len(a) > 0 AND len(e) > 0 THEN len(list_intersect(a, e))::DOUBLE / len(list_distinct(list_concat(a, e))) END AS overlap FROM c""")
def evidence_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlap of an answer with its evidence (the turn before); two kinds of turns are skipped."""
    before = F.lag("text").over(Window.partitionBy("conv_id").orderBy("turn", "text"))
    told = load(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text", F.coalesce(before, F.lit("")).alias("before"))
    counted = (F.col("role") != "system") & (F.col("turn") % 5 != 4)
    return told.select("conv_id", "turn", F.when(counted, tx.jaccard(tx.content_tokens(F.col("text")), tx.content_tokens(F.col("before")))).alias("overlap"))


@query("""
WITH h AS (SELECT user_id, event_id AS place, event_type AS kind FROM events WHERE event_type <> 'view' UNION ALL SELECT DISTINCT user_id, -1, 'initial' FROM events)
SELECT user_id, count(*)::BIGINT AS rounds, sha256(string_agg(kind, ',' ORDER BY place)) AS history, arg_max(kind, place) AS last FROM h GROUP BY user_id""")
def generation_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's history in order, with a first round put in front; its digest and its end.

    The history of a user is gathered in one task, as its digest needs.
    """
    events = load(spark, sf_dir, "events")
    first = events.select("user_id").distinct().select("user_id", F.lit(-1).cast("long").alias("at"), F.lit("initial").alias("kind"))
    rounds = events.where("event_type <> 'view'").select("user_id", F.col("event_id").alias("at"), F.col("event_type").alias("kind")).unionByName(first)
    told = rounds.groupBy("user_id").agg(F.count("*").alias("rounds"), F.array_sort(F.collect_list(F.struct("at", "kind"))).alias("h"), F.max_by("kind", "at").alias("last"))
    return told.select("user_id", "rounds", F.sha2(F.array_join(F.transform("h", lambda x: x["kind"]), ","), 256).alias("history"), "last")


_IDENTITY = errors_sql(("item_missing", "named IS NULL"), ("stage_item_mismatch", "named // 100000 <> l_partkey"), ("section_mismatch", "named % 100000 % 3 <> l_suppkey % 3"))


@query(f"""
WITH f AS (SELECT l_orderkey AS k, max(l_partkey * 100000 + l_suppkey) AS named FROM lineitem WHERE l_linenumber = 1 GROUP BY 1)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {_IDENTITY} AS errors FROM lineitem LEFT JOIN f ON k = l_orderkey""")
def identity_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of an order against its first one, as a later stage's record against the item it names: there at all, the same item, the same section."""
    lines = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    first = lines.where("l_linenumber = 1").groupBy(F.col("l_orderkey").alias("k")).agg(F.max(F.struct("l_partkey", "l_suppkey")).alias("named"))
    met = lines.join(first, F.col("l_orderkey") == F.col("k"), "left")
    rules = [("item_missing", F.col("named").isNull()), ("stage_item_mismatch", F.col("named.l_partkey") != F.col("l_partkey")), ("section_mismatch", F.col("named.l_suppkey") % 3 != F.col("l_suppkey") % 3)]
    return met.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", errors(*rules).alias("errors"))


_FINAL = errors_sql(("payload_without_acceptance", "s <> 'F' AND payload IS NOT NULL"), ("acceptance_without_payload", "s = 'F' AND payload IS NULL"), ("history_ends_elsewhere", "last IS NOT NULL AND s <> 'P' AND last <> s"), ("mirror_differs", "mirror <> s"))


@query(f"""
WITH h AS (SELECT l_orderkey, right(max(l_linenumber || l_linestatus), 1) AS last FROM lineitem GROUP BY l_orderkey),
r AS (SELECT o_orderkey, o_orderstatus AS s, CASE WHEN o_orderkey % 11 = 0 OR o_orderstatus = 'F' AND o_orderkey % 13 > 0 THEN o_totalprice END AS payload, CASE WHEN o_orderkey % 17 = 0 THEN 'X' ELSE o_orderstatus END AS mirror, last FROM orders LEFT JOIN h ON l_orderkey = o_orderkey)
SELECT o_orderkey, {_FINAL} AS errors FROM r""")
def final_record_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Final records: a payload if and only if accepted, a history that ends in the state, mirrors that agree."""
    last = F.right(F.max(F.concat(F.col("l_linenumber").cast("string"), "l_linestatus")), F.lit(1)).alias("last")
    history = load(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(last)
    payload = F.expr("CASE WHEN o_orderkey % 11 = 0 OR o_orderstatus = 'F' AND o_orderkey % 13 > 0 THEN o_totalprice END")
    mirror = F.expr("CASE WHEN o_orderkey % 17 = 0 THEN 'X' ELSE o_orderstatus END")
    records = load(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("s"), payload.alias("payload"), mirror.alias("mirror")).join(history, "o_orderkey", "left")
    s, end = F.col("s"), F.col("last")
    rules = [("payload_without_acceptance", (s != "F") & F.col("payload").isNotNull()), ("acceptance_without_payload", (s == "F") & F.col("payload").isNull()), ("history_ends_elsewhere", end.isNotNull() & (s != "P") & (end != s)), ("mirror_differs", F.col("mirror") != s)]
    return records.select("o_orderkey", errors(*rules).alias("errors"))


@query("""
WITH p AS (SELECT n_nationkey, n_name, n_regionkey, 'sha256:' || sha256('{"n_name":"' || n_name || '","n_nationkey":' || n_nationkey || ',"n_regionkey":' || n_regionkey || '}') AS digest, 'sha256:' || sha256('{"n_name":"' || n_name || '","n_nationkey":' || n_nationkey || ',"n_regionkey":' || (CASE WHEN n_nationkey % 4 = 0 THEN n_regionkey + 1 ELSE n_regionkey END) || '}') AS expected FROM nation)
SELECT n_nationkey, digest, CASE WHEN digest = expected THEN 'PASS' ELSE 'FAIL' END AS status FROM p""")
def policy_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Policy records by the digest of their canonical form, verified against the expected one."""
    policy = load(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    stored = policy.withColumn("n_regionkey", F.when(F.col("n_nationkey") % 4 == 0, F.col("n_regionkey") + 1).otherwise(F.col("n_regionkey")))
    own = policy.select("n_nationkey", canonical("n_nationkey", "n_name", "n_regionkey").alias("digest"))
    expected = stored.select("n_nationkey", canonical("n_nationkey", "n_name", "n_regionkey").alias("expected"))
    return own.join(expected, "n_nationkey").select("n_nationkey", "digest", F.when(F.col("digest") == F.col("expected"), "PASS").otherwise("FAIL").alias("status"))


_RATED = "WITH o AS (SELECT p_partkey // 4 AS item, substring('ABCD', (p_partkey % 4)::INT + 1, 1) AS letter, p_name FROM part), r AS (SELECT item, CASE item % 5 WHEN 0 THEN 'no such option' WHEN 1 THEN upper(p_name) ELSE p_name END AS answer FROM o WHERE letter = substring('ABCD', (item % 4)::INT + 1, 1))"


@query(f"""
{_RATED}, m AS (SELECT r.item, r.answer, count(o.letter) AS n, min(o.letter) AS letter FROM r LEFT JOIN o ON o.item = r.item AND o.p_name = r.answer GROUP BY ALL)
SELECT item, CASE WHEN n = 1 THEN letter WHEN n = 0 THEN 'NONE' ELSE 'AMBIGUOUS' END AS answer FROM m""")
def canonical_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers given as an option's text, brought back to its letter; by the exact text, without normalization."""
    letter = lambda n: F.expr(f"substring('ABCD', cast({n} % 4 AS INT) + 1, 1)")
    options = load(spark, sf_dir, "part").select(F.floor(F.col("p_partkey") / 4).cast("long").alias("item"), letter("p_partkey").alias("letter"), "p_name")
    given = F.when(F.col("item") % 5 == 0, "no such option").when(F.col("item") % 5 == 1, F.upper("p_name")).otherwise(F.col("p_name"))
    rated = options.where(F.col("letter") == letter("item")).select("item", given.alias("answer"))
    met = rated.join(options.select("item", "letter", F.col("p_name").alias("answer")), ["item", "answer"], "left")
    told = met.groupBy("item", "answer").agg(F.count("letter").alias("n"), F.min("letter").alias("letter"))
    return told.select("item", F.when(F.col("n") == 1, F.col("letter")).when(F.col("n") == 0, "NONE").otherwise("AMBIGUOUS").alias("answer"))


@query("""
WITH o AS (SELECT sha256(text) AS h, count(*) AS n, min(doc_id) AS first_id FROM documents GROUP BY 1), r AS (SELECT item_id, sha256(text) AS h FROM benchmark UNION ALL SELECT -1 - doc_id, sha256(text) FROM documents WHERE n_chars < 200)
SELECT item_id AS record_id, coalesce(n, 0)::BIGINT AS candidates, first_id FROM r LEFT JOIN o USING (h)""")
def hash_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each recorded hash, how many stored objects have it, and the first of them."""
    digest = F.sha2("text", 256).alias("h")
    docs = load(spark, sf_dir, "documents")
    stored = docs.select("doc_id", digest).groupBy("h").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id"))
    recorded = load(spark, sf_dir, "benchmark").select(F.col("item_id").alias("record_id"), digest).union(docs.where("n_chars < 200").select((-1 - F.col("doc_id")).alias("record_id"), digest))
    return recorded.join(stored, "h", "left").select("record_id", F.coalesce("n", F.lit(0)).alias("candidates"), "first_id")


#: About so many lines at most are dealt to a task.
TASK_LINES = 200_000


@query("""
SELECT o_orderkey, bool_and(l_returnflag <> 'R') AS all_accepted, count(*) = count(DISTINCT l_partkey) AS all_unique, count(*)::BIGINT AS n, bool_and(l_returnflag <> 'R') AND count(*) = count(DISTINCT l_partkey) AND count(l_partkey) > 0 AS valid
FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey""")
def consensus_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether all outcomes of a run are accepted, none twice, and there are any.

    Lines are dealt by their number, so that what a task holds in memory does not grow with them.
    """
    lines = load(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey", (F.col("l_returnflag") != "R").alias("accepted"))
    dealt = lines.repartition(max(-(-lines.count() // TASK_LINES), int(spark.conf.get("spark.sql.shuffle.partitions"))), "o_orderkey")
    met = load(spark, sf_dir, "orders").select("o_orderkey").join(dealt.hint("merge"), "o_orderkey").groupBy("o_orderkey")
    told = met.agg(F.every("accepted").alias("all_accepted"), (F.count("*") == F.count_distinct("l_partkey")).alias("all_unique"), F.count("*").alias("n"))
    return told.withColumn("valid", F.col("all_accepted") & F.col("all_unique") & (F.col("n") > 0))


@query("""
SELECT event_id, user_id * 1000 + row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS child_seed FROM events""")
def child_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A seed for each child: the base of its parent and its index less one."""
    index = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id"))
    return load(spark, sf_dir, "events").select("event_id", (F.col("user_id") * 1000 + index - 1).cast("long").alias("child_seed"))


@query("""
WITH r AS (SELECT item_id, s, k, row_number() OVER (PARTITION BY item_id ORDER BY k DESC, s % 5, length(p), sha256(concat_ws('|', 'pool', item_id::VARCHAR, s::VARCHAR, k::VARCHAR)), s) AS place
  FROM (SELECT item_id, k, s, array_to_string(w[s + 1:s + k], ' ') AS p FROM (SELECT item_id, w, k, unnest(range(0, len(w) - k + 1)) AS s FROM (SELECT item_id, w, unnest(range(1, 5)) AS k FROM (SELECT item_id, string_split(text, ' ') AS w FROM benchmark)) WHERE len(w) >= k)))
SELECT item_id, s::BIGINT AS start, k::BIGINT AS k, place::BIGINT AS place FROM r WHERE place <= 56""")
def ranked_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 56 windows of each item along three keys, in hash order where these tie."""
    words = load(spark, sf_dir, "benchmark").select("item_id", F.split("text", " ").alias("w"), F.explode(F.sequence(F.lit(1).cast("long"), F.lit(4).cast("long"))).alias("k")).where(F.size("w") >= F.col("k"))
    spans = words.select("item_id", "w", "k", F.explode(F.sequence(F.lit(0).cast("long"), F.size("w") - F.col("k"))).alias("s"))
    phrase = F.array_join(F.slice("w", F.col("s").cast("int") + 1, F.col("k").cast("int")), " ")
    told = spans.select("item_id", "s", "k", F.length(phrase).alias("n"))
    best = top_by(told, ["item_id"], [F.col("k").desc(), F.col("s") % 5, F.col("n"), hash_order("pool", "item_id", "s", "k"), F.col("s")], 56)
    return best.select("item_id", F.col("s").alias("start"), "k", F.col("rank").cast("long").alias("place"))


def _entry_sql(name: str, kind: str, digest: str) -> str:
    return f"('0x' || substring(sha256(concat_ws('|', {name}, '{kind}', {digest})), 1, 15))::BIGINT"


@query(f"""
WITH f AS (SELECT lang, doc_id // 250 AS b, sha256(string_agg(doc_id || ':' || n_chars || chr(10), '' ORDER BY doc_id, n_chars)) AS h FROM documents GROUP BY ALL),
d AS (SELECT lang, b, sha256('1|' || {_entry_sql("'lines.txt'", "file", "h")}) AS h FROM f)
SELECT 'lang=' || lang AS "group", count(*)::BIGINT AS folders, sha256(concat_ws('|', count(*)::VARCHAR, sum({_entry_sql("'b=' || b", "folder", "h")})::VARCHAR)) AS digest FROM d GROUP BY lang""")
def version_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files written and read back, hashed where they lie, folded into a digest of each group: a folder for each language and in it one for each 250 ids."""
    folder = fresh_folder(spark, "versions")
    lines = load(spark, sf_dir, "documents").select("lang", F.expr("doc_id div 250").alias("b"), "doc_id", "n_chars")
    ordered = lines.repartition("lang", "b").sortWithinPartitions("lang", "b", "doc_id", "n_chars")
    ordered.select("lang", "b", F.concat_ws(":", "doc_id", "n_chars").alias("value")).write.partitionBy("lang", "b").text(folder)
    nodes = files.tree(files.leaves(spark, folder).withColumn("path", F.regexp_replace("path", r"part-\d+[^/]*$", "lines.txt")))
    inside = nodes.where("depth = 2").groupBy(F.col("parent").alias("group")).agg(F.count("*").alias("folders"))
    return nodes.where("depth = 1").select(F.col("path").alias("group"), "digest").join(inside, "group").select("group", "folders", "digest")


_RUN = errors_sql(("run_mismatch", "a.run <> b.run"), ("not_in_bundle", "b.k IS NULL"), ("wrong_kind", "a.kind <> b.kind"))


@query(f"""
WITH a AS (SELECT event_id AS k, user_id % 10 AS run, event_type AS kind FROM events), b AS (SELECT event_id AS k, CASE WHEN event_id % 19 = 0 THEN -1 ELSE user_id % 10 END AS run, CASE WHEN event_id % 23 = 0 THEN 'other' ELSE event_type END AS kind FROM events WHERE value > 5)
SELECT a.k AS event_id, {_RUN} AS errors FROM a LEFT JOIN b USING (k)""")
def artifact_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Artifacts against the bundle's list, which lacks some and has others under another run or kind."""
    artifacts = load(spark, sf_dir, "events").select("event_id", (F.col("user_id") % 10).alias("run"), F.col("event_type").alias("kind"), "value")
    listed = artifacts.where("value > 5").select(
        "event_id", F.when(F.col("event_id") % 19 == 0, -1).otherwise(F.col("run")).alias("its_run"), F.when(F.col("event_id") % 23 == 0, "other").otherwise(F.col("kind")).alias("its_kind"), F.lit(True).alias("there"))
    met = artifacts.join(listed, "event_id", "left")
    rules = [("run_mismatch", F.col("run") != F.col("its_run")), ("not_in_bundle", F.col("there").isNull()), ("wrong_kind", F.col("kind") != F.col("its_kind"))]
    return met.select("event_id", errors(*rules).alias("errors"))


@query("""
WITH m AS (SELECT lang, count(*) AS n, max(n_chars) AS longest, count(DISTINCT source) AS sources FROM documents GROUP BY lang)
SELECT 1 AS number, '# Documents by language' AS line UNION ALL SELECT 2, '' UNION ALL SELECT 3, '| lang | n | longest | sources |' UNION ALL SELECT 4, '|---|---|---|---|'
UNION ALL SELECT 4 + row_number() OVER (ORDER BY lang), '| ' || lang || ' | ' || n || ' | ' || longest || ' | ' || sources || ' |' FROM m""")
def metrics_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A Markdown report of a few metrics, line by line; its table is a small aggregate."""
    told = load(spark, sf_dir, "documents").groupBy("lang").agg(F.count("*").alias("n"), F.max("n_chars").alias("longest"), F.count_distinct("source").alias("sources")).orderBy("lang")
    lines = markdown(told, "Documents by language").removesuffix("\n").split("\n")
    return spark.createDataFrame(list(enumerate(lines, 1)), "number long, line string")
