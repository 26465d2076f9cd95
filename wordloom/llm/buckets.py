"""Buckets of rows to be compared with each other, in units of bounded size.

A bucket with more rows than the limit is cut into chunks by hash; each pair of chunks is a
unit of its own. So every two rows of a bucket meet in a unit, no unit holds more than about
twice the limit, and a large bucket becomes many tasks instead of one.

Pairs of chunks grow with the square of a bucket. Most large buckets are made of copies of a few
things, so each row of one is measured against the bucket's first row beforehand. With a distance
that obeys the triangle inequality, rows within reach of the first are in one component already and
need not meet each other; rows beyond twice the reach can't be linked to any of those; and only the
rows between the two meet them. Whatever is out of the first row's reach is a bucket again, until
it is small or a round takes too little away; then pairs of chunks do the rest. No link between
components is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, small

#: Rounds in which a first row is taken from each large bucket, and the share of rows a round must settle.
ROUNDS = 12
SETTLED = 0.04
#: Bits of a unit's number that tell its round from the others.
ROUND_BIT = 48


def _chunk(seed: int, member: str, chunks: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), member), chunks)


def _up_to(chunks: Column) -> Column:
    return F.sequence(F.lit(0).cast("long"), chunks - 1)


def _in_pairs(rows: DataFrame, names: list[str], member: str, limit: int, base: int) -> DataFrame:
    """``rows`` (with n_rows) once per chunk of their bucket, so that each pair of chunks is a unit."""
    told = rows.withColumn("chunks", F.ceil(F.col("n_rows") / limit).cast("long")).withColumn("chunk", _chunk(7, member, F.col("chunks")))
    units = F.transform(_up_to(F.col("chunks")), lambda j: F.least("chunk", j) * F.col("chunks") + F.greatest("chunk", j) + base)
    return told.select(*names, F.explode(units).alias("unit"))


def in_units(rows: DataFrame, key: str, member: str, limit: int, buckets: DataFrame | None = None, payload: str | None = None, distance: Callable[[Column, Column], Column] | None = None, reach: float = 0) -> tuple[DataFrame, DataFrame | None]:
    """(units, links). Units are ``rows`` with a column ``unit``; rows of large buckets are repeated, once per chunk that they meet.

    ``buckets`` is a table with the same keys, as often, which is counted instead if it is given.
    With ``distance``, a metric between the ``payload`` of two rows, rows up to ``reach`` apart are
    linked: links (a, b) then join members of large buckets to a first one, and those linked so
    don't meet each other; links are None without it, or if no bucket is large.
    """
    heavy = cut((rows if buckets is None else buckets).groupBy(key).agg(F.count("*").alias("n_rows")).where(F.col("n_rows") > limit))
    if heavy.isEmpty():
        return rows.withColumn("unit", F.lit(0).cast("long")), None
    names = rows.columns
    units = rows.join(small(heavy.select(key)), key, "left_anti").select(*names, F.lit(0).cast("long").alias("unit"))
    now, links = rows.join(small(heavy), key), None
    if distance is None:
        return units.unionByName(_in_pairs(now, names, member, limit, 0)), None
    for round_ in range(ROUNDS):
        firsts = cut(now.groupBy(key).agg(F.min(F.struct(member, payload)).alias("_least")))
        apart = distance(F.col(f"_least.{payload}"), F.col(payload)).alias("_apart")
        told = cut(now.join(small(firsts), key).select(*names, F.col(f"_least.{member}").alias("_first"), apart))
        near, far = F.col("_apart") <= reach, F.col("_apart") > 2 * reach
        found = told.where(near & (F.col(member) != F.col("_first"))).select(F.col("_first").alias("a"), F.col(member).alias("b"))
        links = found if links is None else links.unionByName(found)
        counts = cut(told.groupBy(key).agg(F.count_if(near).alias("n_near"), F.count_if(~near & ~far).alias("n_between"), F.count_if(~near).alias("n_rows")))
        base = 2 * round_ + 1 << ROUND_BIT
        # Rows between one and two times the reach meet those within it.
        both = told.where(~far).join(small(counts.where("n_between > 0").select(key, "n_near", "n_between")), key)
        mine, others = F.ceil(F.col("n_near") / limit).cast("long"), F.ceil(F.col("n_between") / limit).cast("long")
        as_near = F.transform(_up_to(others), lambda u: u * mine + _chunk(7, member, mine) + base)
        as_between = F.transform(_up_to(mine), lambda c: _chunk(11, member, others) * mine + c + base)
        units = units.unionByName(both.select(*names, F.explode(F.when(near, as_near).otherwise(as_between)).alias("unit")))
        left = told.where(~near).join(small(counts.select(key, "n_rows")), key)
        units = units.unionByName(left.where(F.col("n_rows") <= limit).select(*names, F.lit(base + (1 << ROUND_BIT)).alias("unit")))
        now = left.where(F.col("n_rows") > limit).select(*names, "n_rows")
        before, after = counts.where(F.col("n_rows") > limit).agg(F.sum(F.col("n_near") + F.col("n_rows")), F.sum("n_rows")).first()
        if not after:
            return units, links
        if before - after < SETTLED * before:
            break
    return units.unionByName(_in_pairs(now, names, member, limit, 2 * ROUNDS + 1 << ROUND_BIT)), links


def whole_groups(batches: Iterator[pa.RecordBatch], keys: int, rows: int) -> Iterator[pa.Table]:
    """Tables of about ``rows`` rows that never split a group; batches are sorted by their first ``keys`` columns."""
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        count += batch.num_rows
        if count < rows:
            continue
        table = pa.Table.from_batches(held)
        same = np.ones(table.num_rows, dtype=bool)
        for k in range(keys):
            column = table.column(k).to_numpy()
            same &= column == column[-1]
        first = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        if first:
            yield table.slice(0, first)
        rest = table.slice(first).combine_chunks()
        held, count = rest.to_batches(), rest.num_rows
    if held:
        yield pa.Table.from_batches(held)


def merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after linking ``a`` and ``b`` pairwise; a label is the smallest index linked so far."""
    while len(a):
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            break
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            shorter = label[label]
            if (shorter == label).all():
                break
            label = shorter
    return label
