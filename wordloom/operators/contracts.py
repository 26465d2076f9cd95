"""Rules on texts, options, failures, gates and batches, as expressions and joins."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank_words, normalized, surface
from .raters import reasons

LETTERS = ("A", "B", "C", "D")
ORDINALS = ("first", "second", "third", "fourth", "fifth", "sixth", "seventh", "eighth")
#: Marks of failed calls in their logs.
AUTH_MARKS = ("unauthorized", "authentication", "api key", "invalid token", "login required", "not logged in")
NETWORK_MARKS = ("socket", "websocket", "dns", "econn", "connection refused", "connection reset", "stream disconnected", "failed to connect", "api.openai.com", "timed out waiting for network", "network is unreachable", "network error", "error sending request")
LOG_TAIL = 8000


def stem_reference(stem: Column) -> Column:
    """target, kind (line or paragraph) and number that a stem names; null if it names no readable place."""
    pattern = r"(?i)^the (?:word|phrase|expression) (.+?) in (line \d+|paragraph \d+|(?:the )?\w+ paragraph)\b"
    target = F.regexp_replace(F.regexp_extract(stem, pattern, 1), "^(['\"])(.*)\\1$", "$2")
    place = F.lower(F.regexp_extract(stem, pattern, 2))
    ordinal = F.regexp_extract(place, r"^(?:the )?(\w+) paragraph$", 1)
    nth = F.array_position(F.array(*map(F.lit, ORDINALS)), ordinal)
    number = F.coalesce(F.regexp_extract(place, r"(\d+)$", 1).try_cast("int"), F.when(nth > 0, nth.cast("int")))
    kind = F.when(place.startswith("line"), "line").otherwise("paragraph")
    return F.when(number.isNotNull(), F.struct(F.trim(target).alias("target"), kind.alias("kind"), number.alias("number")))


def has_expression(text: Column, target: Column) -> Column:
    """Whether the target's surface stands in the text's with no word character, apostrophe or hyphen next to it."""
    wanted = surface(target)
    quoted = F.concat(F.lit(r"\Q"), F.replace(wanted, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))
    pattern = F.concat(F.lit(r"(?<![\p{L}\p{N}_'-])"), quoted, F.lit(r"(?![\p{L}\p{N}_'-])"))
    return (wanted != "") & F.regexp_like(surface(text), pattern)


def permuted(options: Column, order: Column) -> Column:
    """A map by letter after a permutation: the i-th letter gets the option of ``order[i]``."""
    return F.map_from_entries(F.array(*[F.struct(F.lit(x).alias("key"), F.element_at(options, F.get(order, F.lit(i))).alias("value")) for i, x in enumerate(LETTERS)]))


def moved_label(label: Column, order: Column) -> Column:
    """Where a letter has gone; null for what is no letter of the order."""
    at = F.array_position(order, label)
    return F.when(at > 0, F.get(F.array(*map(F.lit, LETTERS)), (at - 1).cast("int")))


def copied_answer(options: Column, answer: Column, passage: Column, least: int = 5) -> Column:
    """Whether the answer, of ``least`` words or more, stands in the passage and no other option does."""
    clean = lambda x: F.regexp_replace(normalized(x), r"^[ .,:;!?\"'()\[\]]+|[ .,:;!?\"'()\[\]]+$", "")
    where, right = normalized(passage), clean(F.element_at(options, answer))
    wrong = F.map_filter(options, lambda k, v: (k != answer) & (clean(v) != "") & F.contains(where, clean(v)))
    return (F.size(blank_words(right)) >= least) & F.contains(where, right) & (F.size(F.map_keys(wrong)) == 0)


def failure_class(category: Column, log: Column, exit_code: Column) -> Column:
    """The class of a call; a null category is a success. Only the log's last part is looked at."""
    tail = F.lower(F.right(F.coalesce(log, F.lit("")), F.lit(LOG_TAIL)))

    def marked(marks: Sequence[str]) -> Column:
        return tail.rlike("|".join(map(re.escape, marks)))

    return (
        F.when(category.isNull(), "SUCCESS")
        .when(category.isin("SCHEMA_COMPATIBILITY_ERROR") | marked(("invalid_json_schema", "invalid json schema")), "SCHEMA_COMPATIBILITY_ERROR")
        .when(category.isin("parsing", "MODEL_OUTPUT_ERROR"), "MODEL_OUTPUT_ERROR")
        .when(category.isin("schema", "SCHEMA_ERROR", "CONTRACT_VALIDATION_ERROR"), "CONTRACT_VALIDATION_ERROR")
        .when(marked(AUTH_MARKS), "AUTH_ERROR")
        .when(marked(NETWORK_MARKS), "NETWORK_ERROR")
        .when(exit_code.isNull() & marked(("timeout", "timed out")), "HARNESS_TIMEOUT")
        .when(exit_code.isNull() | (exit_code != 0), "PROCESS_ERROR")
        .otherwise("CONTRACT_VALIDATION_ERROR")
    )


def merge_failures(calls: DataFrame, outcomes: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """keys, category and the first of each kind: calls, and outcomes of which no call has the keys.

    Keys are compared with nulls equal; outcomes of schema and parsing faults count as contract faults.
    """
    known = calls.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    rest = outcomes.join(known, same, "left_anti")
    category = F.when(F.col("category").isin("schema", "parsing"), "CONTRACT_VALIDATION_ERROR").otherwise(F.col("category"))
    both = calls.select(*keys, "category", order).unionByName(rest.select(*keys, category.alias("category"), order))
    return both.groupBy(*keys, "category").agg(F.min(order).alias("first"))


def decision(reviewer: Column, solver: Column, logic: Column, live: Column, crashed: Column) -> Column:
    """A if all gates hold; E for a runtime that failed; B, C, D by the first group that doesn't hold; else E."""
    return (
        F.when(reviewer & solver & logic & live, "A")
        .when(~live & crashed, "E")
        .when(~reviewer, "B")
        .when(~solver, "C")
        .when(~logic, "D")
        .otherwise("E")
    )


def path_allowed(path: Column, prefixes: Sequence[str], patterns: Sequence[str]) -> Column:
    """Whether a path starts with a prefix or fits a pattern: ``*`` stays inside a part, ``**`` doesn't."""
    ok = F.lit(False)
    for prefix in prefixes:
        ok = ok | path.startswith(prefix)
    for pattern in patterns:
        parts = [".*" if x == "**" else "[^/]*" if x == "*" else re.escape(x) for x in re.split(r"(\*\*|\*)", pattern)]
        ok = ok | path.rlike("^" + "".join(parts) + "$")
    return ok


def zoned(text: Column) -> Column:
    """An ISO-8601 time with a zone as a timestamp; null without a zone or if it can't be read."""
    return F.when(text.rlike(r"(Z|[+-]\d{2}:?\d{2})$"), F.try_to_timestamp(text))


def elapsed(start: Column, end: Column) -> Column:
    """Seconds between two zoned times, to the microsecond; null if either can't be read."""
    return F.round((F.unix_micros(zoned(end)) - F.unix_micros(zoned(start))) / 1_000_000, 6)


def differs(declared: Column, computed: Column, tolerance: float = 0.00011) -> Column:
    """Whether a declared number is off by the tolerance or more."""
    return F.abs(declared - computed) >= tolerance


def batch_errors(batches: DataFrame, items: DataFrame, key: str, position: str, item: str, size: str, most: float) -> DataFrame:
    """key and errors of each batch, from one aggregate of its items."""
    facts = items.groupBy(key).agg(
        F.count("*").alias("n"), F.count_distinct(position).alias("d"), F.min(position).alias("lo"), F.max(position).alias("hi"), F.count_distinct(item).alias("items"), F.sum(size).alias("total")
    )
    c = F.col
    told = reasons((c("n").isNull(), "no_items"), (c("n") != c("d"), "duplicate_order"), ((c("lo") != 1) | (c("hi") != c("n")), "order_not_1_to_n"), (c("items") < c("n"), "duplicate_item"), (c("total") > most, "length_window"))
    return batches.join(facts, key, "left").select(key, told.alias("errors"))


def not_allowed(rows: DataFrame, allowed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` with an error where the allow-table doesn't hold their keys."""
    joined = rows.join(allowed.select(*keys).distinct().withColumn("_ok", F.lit(True)), list(keys), "left")
    error = F.when(F.col("_ok").isNull(), F.concat(F.concat_ws("/", *[F.col(k).cast("string") for k in keys]), F.lit(": not allowed")))
    return joined.withColumn("error", error).drop("_ok")
