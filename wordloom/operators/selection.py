"""Deterministic selection: first and last per key, hash-ordered top-k, upserts, draws, quotas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import draw, sha256


#: A table of weights is broadcast and searched for each draw.
MOST_WEIGHTS = 10_000


def top_by(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows of each key; Spark drops the others before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("rank", rank).where(F.col("rank") <= k)


def hash_order(seed: str, *parts: Column | str) -> Column:
    """A fixed pseudo-random order: the SHA-256 of seed and parts."""
    return sha256(F.lit(seed), *parts)


def numbered(rows: DataFrame, order: Column, name: str) -> DataFrame:
    """``rows`` with their number from 0 along a hexadecimal hash.

    Rows are ranked among those with the same first three digits, after the count of rows below
    these; only the counts (4096 at most) meet in one task.
    """
    told = rows.withColumn("_hash", order).withColumn("_head", F.substring("_hash", 1, 3))
    below = F.sum("_n").over(Window.orderBy("_head").rowsBetween(Window.unboundedPreceding, -1))
    counts = told.groupBy("_head").agg(F.count("*").alias("_n")).select("_head", F.coalesce(below, F.lit(0)).alias("_below"))
    own = F.row_number().over(Window.partitionBy("_head").orderBy("_hash"))
    return told.join(F.broadcast(counts), "_head").withColumn(name, own - 1 + F.col("_below")).drop("_hash", "_head", "_below")


def latest_wins(stored: DataFrame, arrived: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Upsert: one row a key, the arrived one with the highest order if there is any."""
    columns = stored.columns
    rest = [c for c in columns if c not in keys]
    both = stored.withColumn("_src", F.lit(0)).unionByName(arrived.select(*columns).withColumn("_src", F.lit(1)))
    best = both.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct("_src", order)).alias("_best"))
    return best.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in rest])


def weighted_choice(draws: DataFrame, weights: DataFrame, name: str, weight: str, *parts: str) -> DataFrame:
    """``name`` for each row of ``draws``, in proportion to integer weights, by hash of ``parts``.

    The weight table is a small dimension: it is counted first, and more than MOST_WEIGHTS rows are an error.
    """
    if weights.count() > MOST_WEIGHTS:
        raise ValueError(f"a table of weights has {MOST_WEIGHTS} rows at most")
    below = F.sum(weight).over(Window.orderBy(name).rowsBetween(Window.unboundedPreceding, -1))
    table = weights.select(name, F.coalesce(below, F.lit(0)).alias("_from"), F.col(weight).alias("_w"))
    total = weights.agg(F.sum(weight).cast("long").alias("_total"))  # one row
    drawn = draws.crossJoin(F.broadcast(total)).withColumn("_at", draw(F.col("_total"), *parts))
    hit = (F.col("_at") >= F.col("_from")) & (F.col("_at") < F.col("_from") + F.col("_w"))
    return drawn.join(F.broadcast(table), hit).drop("_from", "_w", "_total", "_at")


def permutation(labels: Sequence[str], seed: str, key: str) -> Column:
    """The labels in an order that only the seed and the key determine."""
    tagged = F.array(*[F.struct(hash_order(seed, key, F.lit(x)).alias("h"), F.lit(x).alias("x")) for x in labels])
    return F.transform(F.array_sort(tagged), lambda s: s["x"])


def covered(starts_ends: Column) -> Column:
    """Distinct integers covered by half-open intervals."""
    return F.size(F.array_distinct(F.flatten(F.transform(starts_ends, lambda s: F.when(s["end"] > s["start"], F.sequence(s["start"], s["end"] - 1)).otherwise(F.array().cast("array<bigint>"))))))


def quota(rows: DataFrame, group: str, tier: Column, order: Sequence[Column], limit: int) -> DataFrame:
    """Up to ``limit`` rows a group: lower tiers first, in order inside a tier."""
    return top_by(rows.withColumn("tier", tier), [group], [F.col("tier"), *order], limit)


def overlapping(intervals: DataFrame, group: str, start: str, end: str, key: str, width: int) -> DataFrame:
    """Pairs of intervals of a group that overlap, by an equality join on time cells.

    Each interval is put into the cells of ``width`` it touches; a pair is kept in the cell in
    which the later one starts, so it appears once.
    """
    cells = F.sequence(F.floor(F.col(start) / width), F.floor((F.col(end) - 1) / width))
    each = intervals.where(F.col(end) > F.col(start)).withColumn("_cell", F.explode(cells))
    left = each.select(group, "_cell", F.col(key).alias("left"), F.col(start).alias("_s"), F.col(end).alias("_e"))
    right = each.select(group, "_cell", F.col(key).alias("right"), F.col(start).alias("_s2"), F.col(end).alias("_e2"))
    met = left.join(right, [group, "_cell"]).where("left < right AND _s < _e2 AND _s2 < _e")
    return met.where(F.col("_cell") == F.floor(F.greatest("_s", "_s2") / width)).select(group, "left", "right")
