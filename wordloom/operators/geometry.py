"""Geometry of marked spans in a sentence: where they stand, what they cover, how far apart they are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import occurrences

LABELS = ("A", "B", "C", "D")
#: Observed mean gaps between neighbouring spans.
MEAN_GAPS = (3.54, 3.82, 3.77)


def span(words: Column, start: Column, size: Column) -> Column:
    """A half-open span of words, cut off at the sentence's end; null if it would be empty."""
    end = F.least(start + size, F.size(words))
    return F.when((start >= 0) & (start < F.size(words)), F.struct(start.alias("start"), end.alias("end")))


def spans_of(words: Column, phrase: Column) -> Column:
    """Every span at which the phrase's words stand in a row."""
    return F.transform(occurrences(words, phrase), lambda i: F.struct(i.alias("start"), (i + F.size(phrase)).alias("end")))


def diagnostics(words: Column, spans: Column) -> Column:
    """Counts, coverage, unmarked words, gaps and order of an array of spans.

    Coverage counts distinct words; gaps are null where a span is missing; ``ordered`` needs
    every span and none that starts before the one in front of it ends.
    """
    n = F.size(words)
    there = F.array_compact(spans)
    marked = F.size(F.array_distinct(F.flatten(F.transform(there, lambda s: F.sequence(s["start"], s["end"] - 1)))))
    gaps = [F.get(spans, i + 1)["start"] - F.get(spans, i)["end"] for i in range(len(LABELS) - 1)]
    sizes = F.transform(there, lambda s: s["end"] - s["start"])
    ordered = F.lit(True)
    for gap in gaps:
        ordered = ordered & F.coalesce(gap >= 0, F.lit(False))
    return F.struct(
        n.alias("n_words"),
        marked.alias("n_marked"),
        (n - marked).alias("n_unmarked"),
        F.round(F.try_divide(marked.cast("double"), n), 4).alias("coverage"),
        F.array_max(sizes).alias("longest"),
        *[gap.alias(f"gap_{a}{b}") for gap, a, b in zip(gaps, LABELS, LABELS[1:])],
        ordered.alias("ordered"),
    )


def aligned(found_by_label: list[Column]) -> Column:
    """Greedy monotone alignment of labelled phrases, given the occurrences (spans) of each.

    Each label takes its first occurrence that doesn't start before the previous one's end;
    failing that, its first one at all, and the status says so. A label without occurrences is
    unmatched and leaves the position as it was.
    """
    kind = "struct<last:int,spans:array<struct<start:int,end:int>>,status:string>"
    zero = F.struct(F.lit(-1).alias("last"), F.array().alias("spans"), F.lit("aligned").alias("status")).cast(kind)

    def step(held, found):
        after = F.get(F.filter(found, lambda s: s["start"] >= held["last"]), F.lit(0))
        first = F.get(found, F.lit(0))
        chosen = F.coalesce(after, first)
        status = F.when(chosen.isNull(), "unmatched_marked_part").when(after.isNull(), "aligned_with_repeated_or_nonmonotonic_occurrence").otherwise(held["status"])
        return F.struct(F.coalesce(chosen["end"], held["last"]).alias("last"), F.concat(held["spans"], F.array(chosen)).alias("spans"), status.alias("status")).cast(kind)

    return F.aggregate(F.array(*found_by_label), zero, step, lambda held: F.struct(held["spans"].alias("spans"), held["status"].alias("status")))


def best_triples(spans: DataFrame, key: str) -> DataFrame:
    """Of each key the three spans in a row, none touching another, with the least score.

    ``spans`` has key, start, end and a bounded number of rows for each key. The score is the
    distance of the two gaps from the usual ones; positions break ties.
    """
    s = [spans.select(key, *[F.col(c).alias(f"{c}{i}") for c in ("start", "end")]) for i in (1, 2, 3)]
    met = s[0].join(s[1], key).where("start2 > end1").join(s[2], key).where("start3 > end2")
    score = F.round(F.abs(F.col("start2") - F.col("end1") - MEAN_GAPS[0]) + F.abs(F.col("start3") - F.col("end2") - MEAN_GAPS[1]), 6)
    places = ["start1", "end1", "start2", "end2", "start3", "end3"]
    best = met.groupBy(key).agg(F.min(F.struct(score.alias("score"), *places)).alias("b"))
    return best.select(key, "b.*")


def stratified(rows: DataFrame, section: str, target: str, level: str, key: str, n: int) -> DataFrame:
    """``n`` rows a section, picked one by one: the rarest target so far, then the rarest level, then the key.

    Only the first ``n`` keys of each target and level can ever be picked, so each section's task
    holds no more than ``n`` rows of each pair of values.
    """
    first = F.row_number().over(Window.partitionBy(section, target, level).orderBy(key))
    pool = rows.select(section, target, level, key, first.alias("_i")).where(F.col("_i") <= n).drop("_i")

    def pick(frame):
        left, targets, levels, out = frame.sort_values(key).to_dict("records"), {}, {}, []
        while left and len(out) < n:
            one = min(left, key=lambda r: (targets.get(r[target], 0), levels.get(r[level], 0), r[key]))
            left.remove(one)
            targets[one[target]] = targets.get(one[target], 0) + 1
            levels[one[level]] = levels.get(one[level], 0) + 1
            out.append({**one, "rank": len(out) + 1})
        import pandas as pd

        return pd.DataFrame(out, columns=[section, target, level, key, "rank"])

    kinds = dict(rows.dtypes)
    ddl = ", ".join(f"{c} {kinds[c]}" for c in (section, target, level, key)) + ", rank long"
    return pool.groupBy(section).applyInPandas(pick, ddl)
