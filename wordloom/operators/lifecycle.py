"""Item lifecycles as state transitions, audited in batch."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The states and which may follow each; states without followers are terminal.
TRANSITIONS = {
    "GENERATED": ("REVIEWING", "VALIDATION_FAILED", "GENERATION_FAILED"),
    "GENERATION_FAILED": ("GENERATED", "REVIEWING", "SOLVING", "MANUAL_REVIEW"),
    "VALIDATION_FAILED": ("GENERATED", "REVIEWING", "SOLVING", "DISCARDED", "MANUAL_REVIEW"),
    "REVIEWING": ("SOLVING", "REVISE_REQUIRED", "REJECTED", "DISCARDED", "VALIDATION_FAILED", "GENERATION_FAILED"),
    "REVISE_REQUIRED": ("GENERATED", "REVIEWING", "DISCARDED"),
    "SOLVING": ("ACCEPTED", "MANUAL_REVIEW", "DISCARDED", "VALIDATION_FAILED", "GENERATION_FAILED"),
    "REJECTED": (),
    "ACCEPTED": (),
    "MANUAL_REVIEW": (),
    "DISCARDED": (),
}


def allowed(before: Column, after: Column, transitions: Mapping[str, Sequence[str]] = TRANSITIONS) -> Column:
    """Whether a state may follow another; a first state must have none before it."""
    ok = before.isNull()
    for state, followers in transitions.items():
        if followers:
            ok = ok | ((before == state) & after.isin(*followers))
    return ok


def steps(history: DataFrame, key: str, order: Sequence[str], state: str) -> DataFrame:
    """Each state with the one before it, its number, and whether the step is legal."""
    w = Window.partitionBy(key).orderBy(*order)
    told = history.select("*", F.lag(state).over(w).alias("before"), F.row_number().over(w).alias("step"))
    return told.withColumn("legal", allowed(F.col("before"), F.col(state)))


def retries(history: DataFrame, key: str, order: Sequence[str], kind: str, failed: Column, limit: int) -> DataFrame:
    """Running failures of each key and kind, and whether the limit is passed."""
    w = Window.partitionBy(key, kind).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    told = history.withColumn("failures", F.count_if(failed).over(w))
    return told.withColumn("exhausted", F.col("failures") > limit)
