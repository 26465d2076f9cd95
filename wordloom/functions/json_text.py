"""JSON of any depth rewritten as text, without leaving Spark's expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The keys whose values are option labels.
LABEL_KEYS = ("answer_label", "correct_answer", "correct_answer_label", "intended_answer", "intended_answer_label", "answer_key", "generator_answer", "generator_answer_label")


def canonical_json(text: Column) -> Column:
    """A JSON text with sorted keys, no blanks and the shortest escapes; null if it does not parse or a key stands twice in an object."""
    return F.to_json(F.try_parse_json(text))


def relabelled(text: Column, mapping: Column, keys: Sequence[str] = LABEL_KEYS) -> Column:
    """``canonical_json`` of a text in which the texts under one of the keys, at any depth, are those of a map; others stay.

    In canonical JSON a key is the only string before a colon, its quote follows a brace or a comma,
    and a quote inside a string has a backslash before it, so the pattern can't begin or end inside
    a string. Values that are no
    texts, or are not in the map, stay; so do keys that only look alike and prose that quotes one.
    """
    json = canonical_json(text)
    pattern = rf'(?<=[{{,])"(?:{"|".join(map(re.escape, keys))})":"[^"\\]*+(?:\\.[^"\\]*+)*+"'
    hits = F.regexp_extract_all(json, F.lit(pattern), F.lit(0))

    def moved(hit: Column) -> Column:
        key = F.substring_index(hit, ":", 1)
        label = F.substring(hit, F.length(key) + 3, F.length(hit) - F.length(key) - 3)
        return F.concat(key, F.lit(':"'), F.coalesce(F.element_at(mapping, label), label), F.lit('"'))

    pieces = F.zip_with(F.split(json, pattern), F.concat(F.transform(hits, moved), F.array(F.lit(""))), lambda piece, hit: F.concat(piece, hit))
    return F.array_join(pieces, "")
