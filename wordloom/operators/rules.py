"""Record contracts: declared shapes compiled to column expressions that list what is wrong."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from .raters import reasons


def _typed(raw: Column, kind: str) -> Column:
    """Whether a JSON value is of a type; booleans are no integers."""
    value = F.trim(raw)
    return {
        "integer": value.rlike(r"^-?\d+$"),
        "number": value.rlike(r"^-?\d+(\.\d+)?([eE][+-]?\d+)?$"),
        "boolean": value.isin("true", "false"),
        "string": F.lit(True),
        "object": value.startswith("{"),
        "array": value.startswith("["),
        "null": value == "null",
    }[kind]


def _checks(document: Column, schema: Mapping[str, Any], path: str) -> list[tuple[Column, str]]:
    found: list[tuple[Column, str]] = []
    here = path or "$"
    properties = schema.get("properties", {})
    keys = F.json_object_keys(document)
    for name in schema.get("required", ()):
        found.append((~F.array_contains(keys, name), f"{here}.{name}: required"))
    if schema.get("additionalProperties") is False:
        extra = F.size(F.array_except(keys, F.array(*[F.lit(k) for k in properties]))) > 0
        found.append((extra, f"{here}: unknown keys"))
    for name, rule in properties.items():
        raw = F.get_json_object(document, f"$.{name}")
        at = f"{here}.{name}"
        there = raw.isNotNull()
        if "type" in rule:
            kinds = [rule["type"]] if isinstance(rule["type"], str) else rule["type"]
            ok = F.lit(False)
            for kind in kinds:
                ok = ok | _typed(raw, kind)
            found.append((there & ~ok, f"{at}: type"))
        if "enum" in rule:
            found.append((there & ~raw.isin(*map(str, rule["enum"])), f"{at}: enum"))
        if "const" in rule:
            found.append((there & (raw != str(rule["const"])), f"{at}: const"))
        number = raw.try_cast("double")
        if "minimum" in rule:
            found.append((number < rule["minimum"], f"{at}: minimum"))
        if "maximum" in rule:
            found.append((number > rule["maximum"], f"{at}: maximum"))
        if "minLength" in rule:
            found.append((F.length(raw) < rule["minLength"], f"{at}: minLength"))
        if "maxLength" in rule:
            found.append((F.length(raw) > rule["maxLength"], f"{at}: maxLength"))
        if "pattern" in rule:
            found.append((there & ~raw.rlike(rule["pattern"]), f"{at}: pattern"))
        if "minItems" in rule:
            found.append((F.json_array_length(raw) < rule["minItems"], f"{at}: minItems"))
        if "maxItems" in rule:
            found.append((F.json_array_length(raw) > rule["maxItems"], f"{at}: maxItems"))
        if "properties" in rule or "required" in rule:
            found += [(there & F.coalesce(c, F.lit(False)), m) for c, m in _checks(raw, rule, at)]
    for rule in schema.get("allOf", ()):
        if "if" in rule:
            held = F.lit(True)
            for name, want in rule["if"].get("properties", {}).items():
                raw = F.get_json_object(document, f"$.{name}")
                held = held & (raw.isin(*map(str, want["enum"])) if "enum" in want else raw == str(want["const"]))
            for branch, on in (("then", F.coalesce(held, F.lit(False))), ("else", ~F.coalesce(held, F.lit(False)))):
                if branch in rule:
                    found += [(on & F.coalesce(c, F.lit(False)), m) for c, m in _checks(document, rule[branch], path)]
        else:
            found += _checks(document, rule, path)
    return found


def errors(document: Column, schema: Mapping[str, Any]) -> Column:
    """Sorted messages, each with its path, for what breaks the schema in a JSON document.

    Supported: type, enum, const, required, additionalProperties, minimum, maximum, minLength,
    maxLength, pattern, minItems, maxItems, nested properties, allOf and if/then/else. A text
    that is no JSON object has the one error ``$: not an object``.
    """
    broken = F.json_object_keys(document).isNull()
    listed = F.array_sort(reasons(*_checks(document, schema, "")))
    return F.when(broken, F.array(F.lit("$: not an object"))).otherwise(listed)


def leaked(present: Column, allowed: list[str]) -> Column:
    """Keys that must not be there and keys that must, both sorted."""
    names = F.array(*map(F.lit, allowed))
    return F.struct(F.array_sort(F.array_except(present, names)).alias("leaked"), F.array_sort(F.array_except(names, present)).alias("missing"))
