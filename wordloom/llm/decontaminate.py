"""Operator 6: benchmark passages in documents, by a prefix-filtered set join.

A window is a run of item words (10, or the whole of a shorter item); it occurs in a document
where the same words stand in a row. The sets joined are the windows' word shingles. For exact
containment one shingle of each window is a sufficient prefix: the rarest in the corpus. Only
places where a document has such a shingle are candidates; the shingle's offset in the window
gives the start, which must leave room for the window before the document's end; then the
words of the document are compared with the window's.

DataFrame functions only. The corpus is read three times, whatever the size of the benchmark: for
the counts of the shingles, for the places, and for the result. Prefixes of few rows and bytes are
broadcast; more of them are joined by a shuffle of hashes and positions alone, and the
few documents with a candidate are read again to be compared. A row is known by its columns and a
hash of its text, so that nothing hangs on the order or the parts in which rows are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, ascii_lower, cut, row_bytes, small, unused

#: Fixed value: what separates words, once A-Z are lower-cased.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW = 10
SHINGLE = 3
#: Tables are broadcast up to so many rows, if they are small in bytes as well.
BROADCAST_ROWS = 200_000


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), BETWEEN), "")


def n_words(text: Column) -> Column:
    """How many ``words`` there are, without making them; A-Z may stand for a-z here."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def shingles(column: str, size: int) -> Column:
    """Hashes of each run of ``size`` words; empty if there are fewer words."""
    w = F.col(column)
    n = F.size(w) - size
    runs = F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(0))), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(size)]))
    return F.when(n >= 0, runs).otherwise(F.array().cast("array<bigint>"))


def windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """item_id (as a string), words and size of each distinct window of each item."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))
    each = items.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("w", i, window))).alias("window"))
    return each.distinct().withColumn("size", F.size("window"))


def all_shingles(column: str, sizes: list[int]) -> Column:
    """(pos, h) of the shingles of each size; the hash of a shingle depends on its size."""
    parts = [F.transform(shingles(column, k), lambda h, i: F.struct(i.alias("pos"), h.alias("h"))) for k in sizes]
    return F.concat(*parts)


def _small(rows: DataFrame) -> DataFrame:
    """``rows`` (a written table), to be broadcast if they are few and small."""
    return small(rows, BROADCAST_ROWS)


def _fits(rows: DataFrame) -> bool:
    n, size = rows.agg(F.count("*"), F.coalesce(F.sum(row_bytes(rows)), F.lit(0))).first()
    return n <= BROADCAST_ROWS and size <= BROADCAST_BYTES


def shingle_sizes(found: DataFrame, shingle: int) -> list[int]:
    """The shingle sizes that windows need: all those from 1 to ``shingle`` words that are met."""
    return sorted((r[0] for r in found.select(F.least("size", F.lit(shingle))).distinct().collect()), reverse=True)


def prefixes(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> tuple[DataFrame, list[int]]:
    """The rarest shingle of each window that can occur (h, at: its offset, window, size, item_id), and the shingle sizes.

    Shingle counts are over all documents. A window with a shingle that no document has is left
    out, since it occurs nowhere.
    """
    found = cut(windows(benchmark, window))
    sizes = shingle_sizes(found, shingle)
    if not sizes:
        return found.select(F.lit(0).cast("long").alias("h"), F.lit(0).alias("at"), "window", "size", "item_id"), sizes
    own = F.lit(None).cast("array<bigint>")
    for k in sizes:
        own = F.when(F.least("size", F.lit(shingle)) == k, shingles("window", k)).otherwise(own)
    each = cut(found.select("item_id", "window", "size", F.posexplode(own).alias("at", "h")))
    wanted = cut(each.select("h").distinct())
    seen = docs.select(words(F.col("text")).alias("w")).select(F.explode(F.concat(*[shingles("w", k) for k in sizes])).alias("h"))
    counts = seen.join(_small(wanted), "h").groupBy("h").agg(F.count("*").alias("df"))
    told = each.join(counts, "h", "left").withColumn("df", F.coalesce("df", F.lit(0)))
    rarest = told.groupBy("item_id", "window", "size").agg(F.min(F.struct("df", "h", "at")).alias("least"))
    return cut(rarest.where("least.df > 0").select("least.h", "least.at", "window", "size", "item_id")), sizes


def occurrences(docs: DataFrame, prefix: DataFrame, sizes: list[int]) -> DataFrame:
    """The columns of ``docs`` but its text, with a place (start, size) and item_id for each window that occurs in a row."""
    ids = [c for c in docs.columns if c != "text"]
    if not sizes:
        return docs.select(*ids, F.lit(0).alias("start"), F.lit(0).alias("size"), F.lit("").alias("item_id")).where("false")
    split = docs.select(*ids, words(F.col("text")).alias("w"))
    room = (F.col("start") >= 0) & (F.col("start") + F.col("size") <= F.size("w"))
    same = F.slice("w", F.greatest(F.col("start") + 1, F.lit(1)), F.col("size")) == F.col("window")
    start = (F.col("pos") - F.col("at")).alias("start")
    if _fits(prefix):
        each = split.select(*ids, "w", F.inline(all_shingles("w", sizes)))
        met = each.join(F.broadcast(prefix), "h").select(*ids, "w", start, "size", "window", "item_id")
    else:
        # Hashes and positions meet the prefixes; the words come back only where one is met.
        each = split.select(*ids, F.inline(all_shingles("w", sizes)))
        near = cut(each.join(prefix, "h").select(*[F.col(c).alias(f"_{c}") for c in ids], start, "size", "window", "item_id").distinct())
        alike = F.lit(True)
        for c in ids:
            alike = alike & split[c].eqNullSafe(near[f"_{c}"])
        met = split.join(near, alike).select(*ids, "w", "start", "size", "window", "item_id")
    return met.where(room & same).select(*ids, "start", "size", "item_id")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): words, words inside a window, and the items met.

    doc_id, n_words, n_hit, n_items, items (sorted array of item ids as strings), contaminated.
    Null and empty texts have no words. Items without words have no windows; items alike are
    both met. Rows that repeat a doc_id are rows of their own. Other columns are not read;
    empty tables give empty or clean results.
    """
    rows = docs.select("doc_id", F.xxhash64("text").alias("mark"), "text")
    met = _judged(rows, benchmark, window)
    found = met.select(*[F.col(c).alias(f"_{c}") for c in ("doc_id", "mark")], "n_hit", "items")
    own = rows.select("doc_id", "mark", n_words(F.col("text")).alias("n_words"))
    alike = own["doc_id"].eqNullSafe(found["_doc_id"]) & (own["mark"] == found["_mark"])
    told = own.join(_small(found), alike, "left")
    items = F.coalesce("items", F.array().cast("array<string>")).alias("items")
    return told.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"), items, F.col("n_hit").isNotNull().alias("contaminated"))


def _judged(docs: DataFrame, benchmark: DataFrame, window: int) -> DataFrame:
    """n_hit and items of each different row of ``docs`` in which a window occurs."""
    met = occurrences(docs, *prefixes(docs, benchmark.select("item_id", "text"), window))
    ids = [c for c in docs.columns if c != "text"]
    per_row = met.groupBy(*ids).agg(F.collect_set(F.struct("start", "size")).alias("places"), F.array_sort(F.collect_set("item_id")).alias("items"))
    inside = F.array_distinct(F.flatten(F.transform("places", lambda p: F.sequence(p["start"], p["start"] + p["size"] - 1))))
    return cut(per_row.select(*ids, F.size(inside).cast("long").alias("n_hit"), "items"))


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    digest = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return contamination(docs, benchmark, window).select("doc_id", "n_words", "n_hit", "n_items", digest, "contaminated")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` in which no window occurs; rows alike in doc_id and text go together."""
    doc, mark = unused(docs.columns, "_doc"), unused(docs.columns, "_mark")
    judged = _judged(docs.select("doc_id", F.xxhash64("text").alias("mark"), "text"), benchmark, window)
    bad = _small(judged.select(F.col("doc_id").alias(doc), F.col("mark").alias(mark)))
    return docs.join(bad, docs["doc_id"].eqNullSafe(F.col(doc)) & (F.xxhash64(docs["text"]) == F.col(mark)), "left_anti")


def oracle(window: int = WINDOW) -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    cut_up = f"list_filter(string_split_regex(translate(coalesce(text, ''), '{upper}', '{lower}'), '{BETWEEN}'), lambda x: x <> '')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {cut_up} AS w FROM documents),
b AS (SELECT item_id::VARCHAR AS item_id, {cut_up} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, w[i:least(i + {window} - 1, len(w))] AS words
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {window} + 1, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT len(words) AS n FROM win),
runs AS (SELECT r, i, n, w[i:i + n - 1] AS words FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
met AS (SELECT r, i, n, item_id FROM runs JOIN win USING (words)),
hit AS (SELECT r, count(DISTINCT p)::BIGINT AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM met) GROUP BY r),
its AS (SELECT r, count(DISTINCT item_id)::BIGINT AS n_items, array_to_string(list_sort(list(DISTINCT item_id)), ',') AS items FROM met GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN its USING (r)"""
