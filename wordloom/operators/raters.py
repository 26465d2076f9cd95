"""Several raters' judgments by key: agreement, consensus, routing, drift, identity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LETTERS = ("A", "B", "C", "D")


def reasons(*rules: tuple[Column, str]) -> Column:
    """The names of the conditions that hold, in order; an unknown condition doesn't hold."""
    return F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(name)) for c, name in rules]))


def agree2(left: Column, right: Column) -> Column:
    """Two missing answers agree."""
    return left.eqNullSafe(right)


def agree_all(*answers: Column) -> Column:
    """One distinct value, where a missing answer is a value too."""
    first = answers[0]
    out = F.lit(True)
    for a in answers[1:]:
        out = out & first.eqNullSafe(a)
    return out


def consensus(generator: Column, verdict: Column, critical: Column, reviewer: Column, solver: Column, ambiguous: Column, confidence: Column, risk: Column, allowed: Sequence[str] = ("HIGH",), blocked: Sequence[str] = ("HIGH",)) -> Column:
    """failed (conditions), routing and disagreement (reasons) of an item's three judgments."""
    failed = reasons(
        (~verdict.eqNullSafe("PASS"), "verdict"),
        (~critical.eqNullSafe(False), "critical_failure"),
        (~reviewer.eqNullSafe(generator), "reviewer_answer"),
        (~F.coalesce(solver.isin(*LETTERS), F.lit(False)), "solver_letter"),
        (~solver.eqNullSafe(generator), "solver_answer"),
        (~solver.eqNullSafe(reviewer), "solver_reviewer"),
        (~ambiguous.eqNullSafe(False), "ambiguity"),
        (~F.coalesce(confidence.isin(*allowed), F.lit(False)), "confidence"),
        (risk.isin(*blocked), "similarity"),
    )
    has = lambda name: F.array_contains(failed, name)
    other = reasons(
        (has("solver_answer"), "solver_generator_mismatch"),
        (has("solver_reviewer"), "solver_reviewer_mismatch"),
        (has("confidence"), "solver_confidence_low"),
        (has("similarity"), "source_similarity_high"),
        (has("reviewer_answer"), "reviewer_generator_mismatch"),
        (has("critical_failure") | has("verdict"), "reviewer_state_inconsistent"),
    )
    named = F.when(F.size(other) == 0, F.array(F.lit("unspecified_condition_failure"))).otherwise(other)
    clean = F.size(failed) == 0
    routing = F.when(clean, "ACCEPTED").when(solver.eqNullSafe("NONE"), "DISCARDED").otherwise("MANUAL_REVIEW")
    why = F.when(clean, F.array().cast("array<string>")).when(solver.eqNullSafe("AMBIGUOUS"), F.array(F.lit("solver_ambiguous"))).when(solver.eqNullSafe("NONE"), F.array(F.lit("solver_none"))).otherwise(named)
    return F.struct(failed.alias("failed"), routing.alias("routing"), why.alias("disagreement"))


def route_verdict(verdict: Column, revisions: Column, limit: int = 2) -> Column:
    """Where a review sends an item: on, back for revision up to the limit, or out."""
    return F.when(verdict == "PASS", "SOLVING").when(verdict == "REJECT", "REJECTED").when((verdict == "REVISE") & (revisions < limit), "REVISE_REQUIRED").when(verdict == "REVISE", "DISCARDED").otherwise("VALIDATION_FAILED")


def id_sets(expected: DataFrame, supplied: DataFrame, key: str) -> DataFrame:
    """Keys that are on one side only: (key, side), by one full outer join of distinct keys."""
    a = expected.select(key).distinct().withColumn("_e", F.lit(True))
    b = supplied.select(key).distinct().withColumn("_s", F.lit(True))
    side = F.when(F.col("_s").isNull(), "missing").when(F.col("_e").isNull(), "unexpected")
    return a.join(b, key, "full").select(key, side.alias("side")).where("side IS NOT NULL")


def drift(recorded: DataFrame, current: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows of ``recorded`` whose columns differ from the current ones; nulls equal nulls.

    One-sided: rows that only ``current`` has are not reported.
    """
    now = current.select(*keys, *[F.col(c).alias(f"_now_{c}") for c in columns], F.lit(True).alias("_there"))
    joined = recorded.join(now, list(keys), "left")
    changed = reasons(*[(~F.col(c).eqNullSafe(F.col(f"_now_{c}")), c) for c in columns])
    told = joined.select(*keys, F.when(F.col("_there").isNull(), F.array(F.lit("(absent)"))).otherwise(changed).alias("changed"))
    return told.where(F.size("changed") > 0)


def replay(artifact: DataFrame, recomputed: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Every key of either side whose rows are not equal, with the side or columns at fault."""
    a = artifact.select(*keys, *[F.col(c).alias(f"_a_{c}") for c in columns], F.lit(True).alias("_a"))
    b = recomputed.select(*keys, *[F.col(c).alias(f"_b_{c}") for c in columns], F.lit(True).alias("_b"))
    differing = reasons((F.col("_a").isNull(), "(not in artifact)"), (F.col("_b").isNull(), "(invented)"), *[(F.col("_a").isNotNull() & F.col("_b").isNotNull() & ~F.col(f"_a_{c}").eqNullSafe(F.col(f"_b_{c}")), c) for c in columns])
    return a.join(b, list(keys), "full").select(*keys, differing.alias("faults")).where(F.size("faults") > 0)
