"""Cohort measures: descriptive statistics, funnels by dimension, gates, bins, percentiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _whole(c: Column) -> Column:
    return c.cast("decimal(38,0)")


def descriptive(value: str) -> list[Column]:
    """n, mean, median, min, max and sample deviation (0 for one value) of an integer column.

    The deviation comes from exact integer sums, so it doesn't depend on the order of rows.
    """
    v = F.col(value)
    n, total, squares = F.count(v), F.sum(v.cast("long")), F.sum(_whole(v) * _whole(v))
    spread = (_whole(n) * _whole(squares) - _whole(total) * _whole(total)).cast("double")
    deviation = F.when(n > 1, F.sqrt(F.try_divide(spread, (n * (n - 1)).cast("double")))).when(n == 1, F.lit(0.0))
    return [
        n.alias("n"),
        F.try_divide(total.cast("double"), n.cast("double")).alias("mean"),
        F.median(v).alias("median"),
        F.min(v).cast("long").alias("least"),
        F.max(v).cast("long").alias("most"),
        deviation.alias("deviation"),
    ]


def by_dimensions(facts: DataFrame, dimensions: Sequence[str], measures: Sequence[Column]) -> DataFrame:
    """The measures by each dimension alone and over all, as (dimension, value, ...), in one pass."""
    dims = [F.coalesce(F.col(d).cast("string"), F.lit("(null)")) for d in dimensions]
    pairs = F.array(*[F.struct(F.lit(d).alias("dimension"), v.alias("value")) for d, v in zip(dimensions, dims)], F.struct(F.lit("all").alias("dimension"), F.lit("all").alias("value")))
    return facts.select("*", F.explode(pairs).alias("_by")).groupBy("_by.dimension", "_by.value").agg(*measures)


def rate(part: Column, whole: Column) -> Column:
    """Share as a double; null without a denominator."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def gates(measured: DataFrame, rules: Sequence[tuple[str, Column, str, Column]]) -> DataFrame:
    """One row of measures as rows (gate, observed, requirement, passed)."""
    rows = [F.struct(F.lit(n).alias("gate"), o.cast("long").alias("observed"), F.lit(r).alias("requirement"), F.coalesce(p, F.lit(False)).alias("passed")) for n, o, r, p in rules]
    return measured.select(F.inline(F.array(*rows)))


def zero_filled(counts: DataFrame, bins: Sequence[str], name: str, groups: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counts for every group and bin, 0 where there were none."""
    labels = groups.withColumn(name, F.explode(F.array(*map(F.lit, bins))))
    return labels.join(counts, [*keys, name], "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))


def midrank(values: DataFrame, value: str, group: str) -> DataFrame:
    """(rank - 1 + half the ties) / n of each value in its group; needs one row a distinct value.

    Values are counted first, so the window holds distinct values and no rows.
    """
    return midrank_counts(values.groupBy(group, value).agg(F.count("*").alias("ties")), value, group)


def midrank_counts(counted: DataFrame, value: str, group: str) -> DataFrame:
    """The same from counts (``ties``) of each value, which may be 0."""
    before = F.sum("ties").over(Window.partitionBy(group).orderBy(value).rowsBetween(Window.unboundedPreceding, -1))
    total = F.sum("ties").over(Window.partitionBy(group))
    return counted.select(group, value, "ties", ((F.coalesce(before, F.lit(0)) + 0.5 * F.col("ties")) / total).alias("midrank"))


def band(value: Column, limits: Column) -> Column:
    """EXTREME outside the outer limits, WARNING outside the inner ones; limits themselves are inside."""
    return F.when((value < limits["q05"]) | (value > limits["q95"]), "EXTREME").when((value < limits["q10"]) | (value > limits["q90"]), "WARNING").otherwise("PREFERRED")


RANKS = {"PREFERRED": 0, "WARNING": 1, "EXTREME": 2}


def worst(bands: Column) -> Column:
    """The worst of some bands; EXTREME if there is none."""
    ranks = F.create_map(*[F.lit(x) for pair in RANKS.items() for x in pair])
    top = F.array_max(F.transform(bands, lambda b: F.element_at(ranks, b)))
    names = F.array(*[F.lit(k) for k in RANKS])
    return F.coalesce(F.get(names, top), F.lit("EXTREME"))


def quantiles(value: str) -> Column:
    q = F.percentile(value, F.array(*[F.lit(x) for x in (0.05, 0.10, 0.90, 0.95)]))
    return F.struct(*[F.get(q, F.lit(i)).alias(n) for i, n in enumerate(("q05", "q10", "q90", "q95"))])
