"""Recorded runs validated again offline: what was logged, what was decided and what was published, reconciled by item."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def signature(errors: Column) -> Column:
    """Error messages without what differs from item to item: bracketed prefixes go, numbers become #; distinct and sorted."""
    plain = lambda e: F.regexp_replace(F.regexp_replace(e, r"^(?:\[[^\]]*\]\s*)+", ""), r"\d+(?:\.\d+)?", "#")
    return F.array_sort(F.array_distinct(F.transform(errors, plain)))


def reconciled(logs: DataFrame, outcomes: DataFrame, formal: DataFrame, key: str, order: list[Column | str], rules: list[tuple[Column, Column]]) -> DataFrame:
    """Every key of any of the three, with multiplicities, the errors of its last log, and what is wrong.

    ``rules`` are (broken, message) over a log's columns, evaluated anew on the last log of a key by
    ``order``. ``outcomes`` has key and decision (ACCEPTED, FAILED or another). Adds n_logs,
    n_outcomes and n_formal, decision (of one outcome), errors, signature, and
    presence: no_outcome, no_log, repeated_outcome or complete;
    publication: accepted_not_published, published_without_acceptance, published_twice or consistent;
    replay: what the rules say now against the decision: reproduced, not_reproduced (failed, but the
    rules find nothing), missed (accepted with errors), clean, or open.
    Sides are counted before they are joined, so no key's rows meet in one task; null keys are one key.
    """
    found = F.array_compact(F.array(*[F.when(F.coalesce(broken, F.lit(False)), message) for broken, message in rules]))
    last = logs.select(key, found.alias("errors"), F.struct(*order).alias("_order")).groupBy(key).agg(F.count("*").alias("n_logs"), F.max_by("errors", "_order").alias("errors"))
    decided = outcomes.groupBy(key).agg(F.count("*").alias("n_outcomes"), F.min("decision").alias("decision"))
    published = formal.groupBy(key).agg(F.count("*").alias("n_formal"))
    sides = [x.withColumnRenamed(key, f"_{n}") for n, x in enumerate((last, decided, published))]
    met = sides[0].join(sides[1], F.col("_0").eqNullSafe(F.col("_1")), "full")
    # A null key is a key, so it is the counts that tell which side has one.
    named = F.when(F.col("n_logs").isNotNull(), F.col("_0")).otherwise(F.col("_1"))
    met = met.withColumn("_both", named).join(sides[2], F.col("_both").eqNullSafe(F.col("_2")), "full")
    named = F.when(F.col("n_logs").isNotNull() | F.col("n_outcomes").isNotNull(), F.col("_both")).otherwise(F.col("_2"))
    told = met.select(named.alias(key), *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_logs", "n_outcomes", "n_formal")], "decision", F.coalesce("errors", F.array().cast("array<string>")).alias("errors"))
    accepted, failed, wrong = (F.coalesce(c, F.lit(False)) for c in (F.col("decision") == "ACCEPTED", F.col("decision") == "FAILED", F.size("errors") > 0))
    presence = F.when(F.col("n_outcomes") == 0, "no_outcome").when(F.col("n_logs") == 0, "no_log").when(F.col("n_outcomes") > 1, "repeated_outcome").otherwise("complete")
    publication = F.when(accepted & (F.col("n_formal") == 0), "accepted_not_published").when(~accepted & (F.col("n_formal") > 0), "published_without_acceptance").when(F.col("n_formal") > 1, "published_twice").otherwise("consistent")
    replay = F.when(F.col("n_logs") == 0, "open").when(failed & wrong, "reproduced").when(failed, "not_reproduced").when(accepted & wrong, "missed").when(accepted, "clean").otherwise("open")
    return told.select("*", signature(F.col("errors")).alias("signature"), presence.alias("presence"), publication.alias("publication"), replay.alias("replay"))


def signature_classes(told: DataFrame) -> DataFrame:
    """Of each presence, publication and replay: items, items with errors, and how many distinct signatures these have."""
    shown = F.when(F.size("signature") > 0, F.array_join("signature", "; "))
    each = told.groupBy("presence", "publication", "replay", shown.alias("shown")).agg(F.count("*").alias("n"))  # so that no class is counted in one task
    return each.groupBy("presence", "publication", "replay").agg(F.sum("n").alias("items"), F.sum(F.when(F.col("shown").isNotNull(), F.col("n")).otherwise(0)).alias("with_errors"), F.count("shown").alias("signatures"))
