"""Audits of edits, selections, spans and outcomes, and what is derived from a case."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import draw
from ..functions.tables import first_of, looked_up, sum_of
from .contracts import LETTERS, has_expression

#: Words that hardly end a span, conjunctions that hardly start one, words that open
#: a clause, and verbs that make one.
BOUNDARY_WORDS = ("and", "or", "but", "nor", "of", "to", "for", "in", "on", "at", "by", "with")
CONJUNCTIONS = ("and", "or", "but", "nor")
CLAUSE_MARKERS = ("although", "because", "if", "since", "that", "though", "unless", "until", "when", "where", "while", "which", "who", "whom", "whose")
CLAUSE_VERBS = ("is", "are", "was", "were", "be", "been", "has", "have", "had", "does", "do", "did")


# What a span of words is worth, and what adds to it or takes from it.
SPAN_WORTH = 1.0
SPAN_PARTS = {"one word": 0.35, "two words": 0.5, "conjunction first": -0.35, "boundary word last": -0.4}
# The fields of a review by what the case answers: a letter, AMBIGUOUS or anything else.
EXPECTED = {
    "grammar_validity": {"letter": "PASS", "ambiguous": "AMBIGUOUS", "other": "FAIL"},
    "detected_errors": {"letter": 1, "ambiguous": 0, "other": 0},
    "one_error_only": {"letter": "PASS", "ambiguous": "AMBIGUOUS", "other": "AMBIGUOUS"},
    "target_metadata": {"letter": "PASS", "ambiguous": "FAIL", "other": "FAIL"},
}
# Sources of failures, the first that applies.
FAILURE_SOURCES = {"no exit, timed out": "subprocess_timeout", "no exit": "subprocess_error", "CONTRACT_VALIDATION_ERROR": "contract_validation", "SCHEMA_COMPATIBILITY_ERROR": "transport_schema"}


def islands(rows: DataFrame, line: Sequence[str], at: str, max_gap: int, least: int) -> DataFrame:
    """Runs of points on a line: start, end (exclusive) and n of each run of ``least`` or more.

    A run goes on over at most ``max_gap`` places without a point. Repeated points count once in
    the run's extent and each in ``n``; null places are left out.
    """
    order = Window.partitionBy(*line).orderBy(at)
    seen = rows.where(F.col(at).isNotNull()).withColumn("_before", F.lag(at).over(order))
    fresh = F.when(F.col("_before").isNull() | (F.col(at) - F.col("_before") > max_gap + 1), 1).otherwise(0)
    run = seen.withColumn("_run", F.sum(fresh).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    told = run.groupBy(*line, "_run").agg(F.min(at).alias("start"), (F.max(at) + 1).alias("end"), F.count("*").alias("n"))
    return told.where(F.col("end") - F.col("start") >= least).drop("_run")


def edit_errors(edits: Column, start: Column, end: Column, most: int) -> Column:
    """What is wrong with a final edit of a sentence: there must be one, local, inside the declared span.

    ``edits`` are those of ``token_diff`` (sentence to corrected sentence), the span is half-open.
    """
    n = F.size(edits)
    size = F.transform(edits, lambda e: F.greatest(e["i2"] - e["i1"], e["j2"] - e["j1"]))
    outside = F.exists(edits, lambda e: (e["i1"] < start) | (e["i2"] > end))
    return F.array_compact(F.array(
        F.when(n == 0, "no_edit"), F.when(n > 1, "several_edits"), F.when(F.exists(size, lambda s: s > most), "edit_not_local"),
        F.when(start >= end, "empty_span"), F.when(outside, "edit_outside_span")))


def mutation_audit(edits: Column, declared_kind: Column, declared_size: Column) -> Column:
    """Declared against measured: kind, size, and whether the metadata hold."""
    kind = F.when(F.size(edits) == 0, "none").when(F.size(edits) > 1, "several").otherwise(F.get(edits, F.lit(0))["tag"])
    size = F.aggregate(edits, F.lit(0), lambda s, e: s + F.greatest(e["i2"] - e["i1"], e["j2"] - e["j1"]))
    status = F.when(kind.eqNullSafe(declared_kind) & size.eqNullSafe(declared_size), "PASS").otherwise("FAIL")
    return F.struct(kind.alias("kind"), size.alias("size"), status.alias("status"))


def lexical_quality(words: Column) -> Column:
    """Score of a span of lower-cased words: short ones gain, those that start or end badly lose."""
    holds = {"one word": F.size(words) == 1, "two words": F.size(words) == 2, "conjunction first": F.get(words, F.lit(0)).isin(*CONJUNCTIONS), "boundary word last": F.element_at(words, -1).isin(*BOUNDARY_WORDS)}
    return F.round(SPAN_WORTH + sum_of(SPAN_PARTS, holds), 4)


def clause_like(words: Column) -> Column:
    """Whether a span of two words or more opens a clause or has a verb that makes one."""
    verbs = F.array(*map(F.lit, CLAUSE_VERBS))
    return (F.size(words) >= 2) & (F.get(words, F.lit(0)).isin(*CLAUSE_MARKERS) | F.arrays_overlap(words, verbs))


def coherence_class(score: Column) -> Column:
    return F.when(score <= 0, "CLEARLY_INCOHERENT").when(score < 0.35, "BORDERLINE").otherwise("COHERENT")


def resolved_span(spans: DataFrame, key: str, text: Column, wanted: Column) -> DataFrame:
    """The one span of each key whose text is the wanted one: n, and start and end where n is 1."""
    hit = text == wanted
    told = spans.groupBy(key).agg(F.count_if(hit).alias("n"), F.min(F.when(hit, F.col("start"))).alias("start"), F.min(F.when(hit, F.col("end"))).alias("end"))
    return told.select(key, "n", *[F.when(F.col("n") == 1, F.col(c)).alias(c) for c in ("start", "end")])


def target_lines(lines: DataFrame, key: str, target: Column, declared: Column) -> DataFrame:
    """Which line holds each key's target: line, status and the lines that match.

    ``lines`` has key, number (from 1) and line. The declared line stands if it holds the target;
    otherwise the only line that does replaces it, and none or several leave it open.
    """
    hits = lines.groupBy(key, target.alias("target"), declared.alias("declared")).agg(F.array_sort(F.collect_list(F.when(has_expression(F.col("line"), target), F.col("number")))).alias("matches"))
    stands = F.array_contains("matches", F.col("declared"))
    status = F.when(stands, "declared").when(F.size("matches") == 1, "normalized").when(F.size("matches") == 0, "not_found").otherwise("ambiguous")
    line = F.when(stands, F.col("declared")).when(F.size("matches") == 1, F.get("matches", F.lit(0)))
    return hits.select(key, "target", "declared", line.alias("line"), status.alias("status"), "matches")


def adapted_counts(counts: Column, caps: Sequence[int], weights: Sequence[int], once: int, total: Column, *seed: Column | str) -> Column:
    """An observed row of counts, cut to its caps and brought to a total by draws.

    While there are too many, a kind is drawn in proportion to its count and loses one; while
    there are too few, one is drawn by ``weights`` and gains one. The kind numbered ``once`` never
    gains beyond one. Each draw is a hash of the seed and the step.
    """
    places = range(len(caps))
    zero = F.array(*[F.least(F.get(counts, F.lit(i)), F.lit(caps[i])) for i in places]).cast("array<int>")

    def summed(a: Column) -> Column:
        return sum((F.get(a, F.lit(i)) for i in places), F.lit(0))

    def step(held: Column, n: Column) -> Column:
        more = summed(held) < total
        gains = [F.lit(w) if i != once else F.when(F.get(held, F.lit(i)) < 1, w).otherwise(0) for i, w in enumerate(weights)]
        chances = [F.when(more, gains[i]).otherwise(F.get(held, F.lit(i))) for i in places]
        at = draw(sum(chances, F.lit(0)), *seed, n.cast("string"))
        below = [sum(chances[:i], F.lit(0)) for i in places]
        moved = [F.get(held, F.lit(i)) + F.when((at >= below[i]) & (at < below[i] + chances[i]), F.when(more, 1).otherwise(-1)).otherwise(0) for i in places]
        return F.array(*moved).cast("array<int>")

    missing = F.abs(total - summed(zero))
    steps = F.when(missing > 0, F.sequence(F.lit(1), missing.cast("int"))).otherwise(F.array().cast("array<int>"))
    return F.aggregate(steps, zero, step)


def expected_review(case_answer: Column, verdict: Column, given: Column) -> dict[str, Column]:
    """The review that a case leads one to expect, field by field."""
    kind = F.when(case_answer.isin(*LETTERS), "letter").when(case_answer == "AMBIGUOUS", "ambiguous").otherwise("other")
    told = {field: looked_up(by_kind, kind) for field, by_kind in EXPECTED.items()}
    marks = [F.when(case_answer == x, "ERROR").otherwise("ACCEPTABLE") for x in LETTERS]
    position = F.when(kind == "letter", case_answer).otherwise("NONE")
    return told | {"verdict": verdict, "critical_failure": verdict == "REJECT", "answer_match": case_answer == given, "detected_position": position, "assessments": F.concat_ws(",", *marks)}


def selection_errors(candidates: Column, chosen: Column, rejected: Column, n: int) -> Column:
    """What is wrong with a stored selection: it must part the candidates, in their order, and take the first ``n`` eligible ones.

    ``candidates`` are structs (id, eligible) in order; the others are arrays of ids.
    """
    ids = F.transform(candidates, lambda c: c["id"])
    eligible = F.transform(F.filter(candidates, lambda c: c["eligible"]), lambda c: c["id"])
    both = F.concat(chosen, rejected)
    parted = (F.size(both) == F.size(ids)) & (F.array_sort(both) == F.array_sort(ids))
    ordered = F.filter(ids, lambda i: F.array_contains(chosen, i)) == chosen
    return F.array_compact(F.array(
        F.when(~parted, "not_a_partition"), F.when(~ordered, "order_changed"), F.when(F.size(chosen) != n, "wrong_number"), F.when(F.slice(eligible, 1, n) != chosen, "not_the_first_eligible")))


def failure_source(classification: Column, exit_code: Column, detail: Column, provider: Column) -> Column:
    """Where a failure came from; null without one, the provider's own word where no row of the table applies."""
    late = F.lower(F.coalesce(detail, F.lit(""))).rlike("timeout|timed out")
    holds = {name: classification == name for name in FAILURE_SOURCES} | {"no exit, timed out": exit_code.isNull() & late, "no exit": exit_code.isNull()}
    return F.when(classification.isNotNull(), first_of(FAILURE_SOURCES, holds, provider))
