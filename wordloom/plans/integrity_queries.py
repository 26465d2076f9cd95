"""Contracts, projections, hashes and unions over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import json_text as js
from ..functions.hashing import canonical, sha256, table_digest
from ..operators import integrity as ig
from ..operators import rules as ru
from ..sources import file_tree as files
from ..sources.storage import fresh_folder
from .registry import load, query

PROPS = {
    "type": "object",
    "required": ["k"],
    "additionalProperties": False,
    "properties": {"k": {"type": "integer", "minimum": 1, "maximum": 90}},
}


@query(r"""
WITH p AS (SELECT event_id, json_keys(props::JSON) AS ks, json_extract_string(props, '$.k') AS k FROM events)
SELECT event_id, array_to_string(list_sort(list_filter([CASE WHEN NOT list_contains(ks, 'k') THEN '$.k: required' END, CASE WHEN len(list_filter(ks, lambda x: x <> 'k')) > 0 THEN '$: unknown keys' END,
  CASE WHEN k IS NOT NULL AND NOT regexp_full_match(trim(k), '-?\d+') THEN '$.k: type' END, CASE WHEN TRY_CAST(k AS DOUBLE) < 1 THEN '$.k: minimum' END, CASE WHEN TRY_CAST(k AS DOUBLE) > 90 THEN '$.k: maximum' END], lambda x: x IS NOT NULL)), '; ') AS errors FROM p""")
def props_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Properties of each event against a declared schema."""
    return load(spark, sf_dir, "events").select("event_id", F.array_join(ru.errors(F.col("props"), PROPS), "; ").alias("errors"))


_AS_JSON = "CASE doc_id % 4 WHEN 0 THEN '{\"id\":' || doc_id || ',\"kind\":\"' || lang || '\",\"note\":null}' WHEN 1 THEN '{\"id\":\"x\",\"kind\":\"' || lang || '\",\"_t\":1}' WHEN 2 THEN '{\"kind\":\"zz\"}' ELSE '[1]' END"
RECORD = {
    "required": ["id", "kind"],
    "properties": {"id": {"type": "integer"}, "kind": {"enum": ["en", "fr", "de", "es"], "minLength": 2}},
    "allOf": [{"if": {"properties": {"kind": {"const": "de"}}}, "then": {"required": ["note"]}}],
}


@query(f"""
WITH r AS (SELECT doc_id, {_AS_JSON} AS j FROM documents), p AS (SELECT doc_id, j, CASE WHEN starts_with(j, '{{') THEN json_keys(j::JSON) END AS ks, json_extract_string(j, '$.id') AS id, json_extract_string(j, '$.kind') AS kind FROM r)
SELECT doc_id, CASE WHEN ks IS NULL THEN '$: not an object' ELSE array_to_string(list_sort(list_filter([CASE WHEN NOT list_contains(ks, 'id') THEN '$.id: required' END, CASE WHEN NOT list_contains(ks, 'kind') THEN '$.kind: required' END,
  CASE WHEN id IS NOT NULL AND NOT regexp_full_match(id, '-?[0-9]+') THEN '$.id: type' END, CASE WHEN kind NOT IN ('en', 'fr', 'de', 'es') THEN '$.kind: enum' END,
  CASE WHEN kind = 'de' AND NOT list_contains(ks, 'note') THEN '$.note: required' END], lambda x: x IS NOT NULL)), '; ') END AS errors FROM p""")
def record_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of several shapes against a schema with a conditional part."""
    docs = load(spark, sf_dir, "documents").select("doc_id", F.expr(_AS_JSON).alias("j"))
    return docs.select("doc_id", F.array_join(ru.errors(F.col("j"), RECORD), "; ").alias("errors"))


@query(f"""
WITH r AS (SELECT doc_id, {_AS_JSON} AS j FROM documents), k AS (SELECT doc_id, CASE WHEN starts_with(j, '{{') THEN json_keys(j::JSON) ELSE [] END AS ks FROM r)
SELECT doc_id, array_to_string(list_sort(list_filter(ks, lambda x: x NOT IN ('id', 'kind'))), ',') AS leaked, array_to_string(list_sort(list_filter(['id', 'kind'], lambda x: NOT list_contains(ks, x))), ',') AS missing FROM k""")
def leakage_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys beyond an allow-list, and those of it that are not there; what is no object has no keys."""
    keys = F.coalesce(F.json_object_keys(F.expr(_AS_JSON)), F.array().cast("array<string>"))
    docs = load(spark, sf_dir, "documents").select("doc_id", keys.alias("ks"))
    told = ru.leaked(F.col("ks"), ["id", "kind"])
    return docs.select("doc_id", told.alias("t")).select("doc_id", F.array_join("t.leaked", ",").alias("leaked"), F.array_join("t.missing", ",").alias("missing"))


_NOTED = """CASE doc_id % 4 WHEN 0 THEN '{"id":' || doc_id || ',"kind":"' || lang || '","note":' || CASE WHEN doc_id % 3 = 0 THEN 'null' ELSE '"n"' END || '}' WHEN 1 THEN '{"_t":1,"id":"x","kind":null}' WHEN 2 THEN '{"_a":{"b":1}}' ELSE '[1]' END"""


@query(f"""
WITH r AS (SELECT doc_id, ({_NOTED})::JSON AS j FROM documents), k AS (SELECT doc_id, j, CASE WHEN json_type(j) = 'OBJECT' THEN json_keys(j) END AS ks FROM r)
SELECT doc_id, CASE WHEN ks IS NOT NULL THEN array_to_string(list_filter(ks, lambda x: NOT starts_with(x, '_') AND json_extract_string(j, '$.' || x) IS NOT NULL), ',') END AS kept FROM k""")
def stripped_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys left when internal ones (``_``) and nulls are dropped; null for what is no object."""
    entries = F.from_json(F.expr(_NOTED), "map<string,string>")
    kept = F.map_filter(entries, lambda k, v: ~k.startswith("_") & v.isNotNull())
    return load(spark, sf_dir, "documents").select("doc_id", F.array_join(F.map_keys(kept), ",").alias("kept"))


@query("""SELECT doc_id, 'sha256:' || sha256('{"doc_id":' || doc_id || ',"lang":"' || lang || '","n_chars":' || n_chars || ',"source":"' || source || '"}') AS digest FROM documents""")
def canonical_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of each row as canonical JSON."""
    return load(spark, sf_dir, "documents").select("doc_id", canonical("source", "doc_id", "n_chars", "lang").alias("digest"))


@query("""
WITH r AS (SELECT lang, ('0x' || substring(sha256(concat_ws('|', doc_id::VARCHAR, text)), 1, 15))::BIGINT AS n FROM documents)
SELECT lang, sha256(concat_ws('|', count(*)::VARCHAR, sum(n)::VARCHAR)) AS digest FROM r GROUP BY lang""")
def table_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A digest of each language's rows that holds in any order."""
    docs = load(spark, sf_dir, "documents").select("lang", sha256("doc_id", "text").alias("d"))
    return docs.groupBy("lang").agg(table_digest(F.col("d")).alias("digest"))


@query("""
WITH u AS (SELECT 'documents' AS section, doc_id AS id, text FROM documents UNION ALL SELECT 'benchmark', item_id, text FROM benchmark UNION ALL SELECT 'turns', conv_id * 100 + turn, text FROM conversations),
d AS (SELECT text FROM u GROUP BY text HAVING count(*) > 1)
SELECT section, count(*)::BIGINT AS n, count(*) FILTER (text IN (SELECT text FROM d))::BIGINT AS n_shared FROM u GROUP BY section""")
def union_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three sections in one table, with how many texts are not unique across it."""
    one = lambda name, table, key: load(spark, sf_dir, table).select(F.lit(name).alias("section"), F.expr(key).alias("id"), F.sha2("text", 256).alias("digest"))
    u = one("documents", "documents", "doc_id").unionByName(one("benchmark", "benchmark", "item_id")).unionByName(one("turns", "conversations", "conv_id * 100 + turn"))
    per = u.groupBy("digest", "section").agg(F.count("*").alias("n"))
    times = per.groupBy("digest").agg(F.sum("n").alias("all"))
    told = per.join(times, "digest")
    return told.groupBy("section").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("all") > 1, F.col("n")).otherwise(0)).alias("n_shared"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_orderkey || ':' || o_orderpriority END AS public, CASE WHEN o_orderstatus <> 'F' THEN 'state ' || o_orderstatus END AS audit FROM orders""")
def public_and_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A public record for accepted items, an audit note for the others."""
    done = F.col("o_orderstatus") == "F"
    public = F.when(done, F.concat_ws(":", "o_orderkey", "o_orderpriority"))
    return load(spark, sf_dir, "orders").select("o_orderkey", public.alias("public"), F.when(~done, F.concat(F.lit("state "), "o_orderstatus")).alias("audit"))


@query("""
WITH n AS (SELECT p_partkey // 4 AS item, p_partkey % 4 AS i, p_name FROM part)
SELECT item, max(CASE WHEN i = 0 THEN p_name END) AS "A", max(CASE WHEN i = 1 THEN p_name END) AS "B", max(CASE WHEN i = 2 THEN p_name END) AS "C", max(CASE WHEN i = 3 THEN p_name END) AS "D" FROM n GROUP BY item""")
def options_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of options (four parts in a row) as the four columns of an item."""
    rows = load(spark, sf_dir, "part").select(F.floor(F.col("p_partkey") / 4).cast("long").alias("item"), (F.col("p_partkey") % 4).cast("int").alias("i"), "p_name")
    return rows.groupBy("item").pivot("i", [0, 1, 2, 3]).agg(F.max("p_name")).toDF("item", "A", "B", "C", "D")


@query("""
SELECT item_id, i AS number, s AS sentence FROM (SELECT item_id, unnest(list_filter(string_split(text, '. '), lambda x: x <> '')) AS s, generate_subscripts(list_filter(string_split(text, '. '), lambda x: x <> ''), 1)::BIGINT AS i FROM benchmark)""")
def visible_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested parts as rows with their number from 1."""
    parts = F.filter(F.split("text", r"\. "), lambda x: x != "")
    return load(spark, sf_dir, "benchmark").select("item_id", F.posexplode(parts).alias("i", "sentence")).select("item_id", (F.col("i") + 1).cast("long").alias("number"), "sentence")


_RECORD = """'{"id": ' || o_orderkey || ', "answer_key": "' || L || '", "parts": [{"answers": "A", "correct_answer": "' || M || '", "Answer_Key": "A"}, ["A", {"deep": [[{"answer_label": "' || L || '"}]]}]], "intended_answer": null, "generator_answer": 3, "note": "the \\\\"answer_key\\\\":\\\\"A\\\\" said: A"}'"""
_L, _M = "chr((65 + o_orderkey % 5)::INT)", "chr((65 + o_custkey % 4)::INT)"
_NEW_L, _NEW_M = "CASE WHEN o_orderkey % 5 < 4 THEN chr((65 + (o_orderkey % 5 + o_custkey % 4 + 1) % 4)::INT) ELSE 'E' END", "chr((65 + (2 * (o_custkey % 4) + 1) % 4)::INT)"


@query(f"""
SELECT o_orderkey, '{{"answer_key":"' || L || '","generator_answer":3,"id":' || o_orderkey || ',"intended_answer":null,"note":"the \\"answer_key\\":\\"A\\" said: A","parts":[{{"Answer_Key":"A","answers":"A","correct_answer":"' || M || '"}},["A",{{"deep":[[{{"answer_label":"' || L || '"}}]]}}]]}}' AS record
FROM (SELECT *, {_NEW_L} AS L, {_NEW_M} AS M FROM orders)""")
def relabelled_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Option labels of nested records after a permutation, moved under the keys that name one and nowhere else."""
    letters = [F.expr(x.replace("::INT", "")).alias(name) for x, name in ((_L, "L"), (_M, "M"))]
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", *letters)
    new = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.chr(F.lit(65) + (i + F.col("o_custkey") % 4 + 1) % 4))
    mapping = F.map_from_arrays(F.array(*map(F.lit, "ABCD")), new)
    return orders.select("o_orderkey", js.relabelled(F.expr(_RECORD), mapping).alias("record"))


def _part_files(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Nodes of a tree of files of lines: a folder for each brand and in it one for each type."""
    folder = fresh_folder(spark, "parts")
    line = F.concat_ws("|", "p_partkey", "p_name", "p_size")
    rows.select("p_brand", "p_type", line.alias("value")).repartition("p_brand", "p_type").sortWithinPartitions("p_brand", "p_type", "value").write.partitionBy("p_brand", "p_type").text(folder)
    named = files.leaves(spark, folder)
    # Which task wrote a file is no part of what is frozen.
    return files.tree(named.withColumn("path", F.regexp_replace("path", r"part-\d+[^/]*$", "lines.txt")))


@query("""
WITH f AS (SELECT p_brand, p_type, p_partkey || '|' || p_name || '|' || p_size AS v FROM part WHERE p_type <> 'LARGE' OR p_brand <> 'Brand#3'),
n AS (SELECT p_brand, p_type, p_partkey || '|' || p_name || '|' || CASE WHEN p_retailprice > 995 THEN p_size + 1 ELSE p_size END AS v FROM part WHERE p_brand <> 'Brand#5' OR p_type <> 'PROMO'),
a AS (SELECT p_brand, p_type, string_agg(v, chr(10) ORDER BY v) AS v FROM f GROUP BY ALL), b AS (SELECT p_brand, p_type, string_agg(v, chr(10) ORDER BY v) AS v FROM n GROUP BY ALL),
d AS (SELECT coalesce(a.p_brand, b.p_brand) AS brand, coalesce(a.p_type, b.p_type) AS type, CASE WHEN b.v IS NULL THEN 'missing' WHEN a.v IS NULL THEN 'added' ELSE 'changed' END AS drift FROM a FULL JOIN b ON a.p_brand = b.p_brand AND a.p_type = b.p_type WHERE a.v IS DISTINCT FROM b.v),
w AS (SELECT brand, CASE WHEN brand NOT IN (SELECT p_brand FROM b) THEN 'missing' WHEN brand NOT IN (SELECT p_brand FROM a) THEN 'added' ELSE 'changed' END AS drift FROM d GROUP BY brand)
SELECT '' AS path, 'folder' AS kind, 'changed' AS drift WHERE EXISTS (SELECT 1 FROM d) UNION ALL SELECT 'p_brand=' || replace(brand, '#', '%23'), 'folder', drift FROM w
UNION ALL SELECT 'p_brand=' || replace(brand, '#', '%23') || '/p_type=' || type, 'folder', drift FROM d UNION ALL SELECT 'p_brand=' || replace(brand, '#', '%23') || '/p_type=' || type || '/lines.txt', 'file', drift FROM d""")
def file_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Real files frozen as a tree of digests, and what has drifted in a later writing of them."""
    parts = load(spark, sf_dir, "part")
    frozen = _part_files(spark, parts.where("p_type <> 'LARGE' OR p_brand <> 'Brand#3'"))
    later = parts.where("p_brand <> 'Brand#5' OR p_type <> 'PROMO'").withColumn("p_size", F.when(F.col("p_retailprice") > 995, F.col("p_size") + 1).otherwise(F.col("p_size")))
    return files.drift(frozen, _part_files(spark, later))


@query("""
SELECT 'orders' AS section, o_orderkey AS item_id, o_orderstatus AS label, round(o_totalprice, 2) AS amount FROM orders UNION ALL SELECT 'parts', p_partkey, p_brand, round(p_retailprice, 2) FROM part
UNION ALL SELECT 'customers', c_custkey, c_mktsegment, round(c_acctbal, 2) FROM customer""")
def verified_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three sections' runs, published, verified by their manifests and brought to one form."""
    kinds = {
        "orders": ("orders", "o_orderkey long, o_orderstatus string, o_totalprice double"),
        "parts": ("part", "p_partkey long, p_brand string, p_retailprice double"),
        "customers": ("customer", "c_custkey long, c_mktsegment string, c_acctbal double"),
    }
    folder, sections = fresh_folder(spark, "sections"), {}
    for section, (table, schema) in kinds.items():
        key, label, amount = (c.split()[0] for c in schema.split(", "))
        run = ig.publish({"items": load(spark, sf_dir, table).select(key, label, amount)}, folder)
        sections[section] = (run, "items", schema, {"item_id": F.col(key), "label": F.col(label), "amount": F.round(F.col(amount), 2)})
    return ig.verified_union(spark, sections, "item_id")
