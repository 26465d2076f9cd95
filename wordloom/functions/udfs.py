"""Vectorised Python functions for what Spark has no expression for."""

from __future__ import annotations

import re
import string
import unicodedata
from bisect import bisect_left, bisect_right
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Types are objects, as type strings would need a session at import.
EDIT = T.StructType([T.StructField("tag", T.StringType()), *[T.StructField(n, T.IntegerType()) for n in ("i1", "i2", "j1", "j2")]])


@F.pandas_udf(T.StringType())
def casefold(text: pd.Series) -> pd.Series:
    return text.str.casefold()


@F.pandas_udf(T.StringType())
def nfkc_surface(text: pd.Series) -> pd.Series:
    """Compatibility form, single blanks, casefolded."""
    return text.map(lambda t: " ".join(unicodedata.normalize("NFKC", t).split()).casefold(), na_action="ignore")


@F.pandas_udf(T.StringType())
def nfc(text: pd.Series) -> pd.Series:
    return text.map(lambda t: unicodedata.normalize("NFC", t), na_action="ignore")


PLAIN = str.maketrans("‘’“”–—", "''\"\"--")
EDGES = string.punctuation + " "
SPAN = T.StructType([T.StructField(n, T.IntegerType()) for n in ("start", "end")])


def nfc_pieces(text: str):
    """(NFC form, start, end) of the pieces of a text that NFC changes by themselves; pieces of text in NFC are its characters."""
    if unicodedata.is_normalized("NFC", text):
        yield from ((c, i, i + 1) for i, c in enumerate(text))
        return
    form, start = "", 0
    for i, c in enumerate(text):
        own = unicodedata.normalize("NFC", c)
        joined = unicodedata.normalize("NFC", text[start : i + 1])
        if i > start and not unicodedata.combining(c) and joined == form + own:
            yield form, start, i
            form, start = own, i
        else:
            form = joined
    yield form, start, len(text)


def surface_with_offsets(text: str) -> tuple[str, list[tuple[int, int]]]:
    """The surface of a text (NFC, plain quotes and dashes, single blanks, bare edges, casefolded), and where each of its characters stands in the text as given."""
    plain = re.sub(r"\s", " ", text).translate(PLAIN)
    if "  " not in plain and len(plain.casefold()) == len(plain) and unicodedata.is_normalized("NFC", text):
        # Each character stays one, so offsets only shift by what is cut off in front.
        start, bare = len(plain) - len(plain.lstrip(EDGES)), plain.strip(EDGES)
        return bare.casefold(), list(zip(range(start, start + len(bare)), range(start + 1, start + len(bare) + 1)))
    parts: list[tuple[str, int, int]] = []
    for form, start, end in nfc_pieces(text):
        for c in form:
            if not c.isspace():
                parts.append((c.translate(PLAIN), start, end))
            elif parts and parts[-1][0] == " ":
                parts[-1] = (" ", parts[-1][1], end)
            else:
                parts.append((" ", start, end))
    inner = [i for i, (c, _, _) in enumerate(parts) if c not in string.punctuation and c != " "]
    out, places = [], []
    for c, start, end in parts[inner[0] : inner[-1] + 1] if inner else ():
        folded = c.casefold()
        out.append(folded)
        places += [(start, end)] * len(folded)
    return "".join(out), places


@F.pandas_udf(T.ArrayType(SPAN))
def expression_spans(text: pd.Series, target: pd.Series) -> pd.Series:
    """Where the target's surface stands as a whole expression in the text's, in offsets of the text."""

    def one(text, target):
        if pd.isna(text) or pd.isna(target):
            return None
        wanted, _ = surface_with_offsets(target)
        found, places = surface_with_offsets(text)
        hits = re.finditer(rf"(?<![\w'-]){re.escape(wanted)}(?![\w'-])", found) if wanted else ()
        return [{"start": places[m.start()][0], "end": places[m.end() - 1][1]} for m in hits]

    return pd.Series([one(a, b) for a, b in zip(text, target)])


@F.pandas_udf(T.ArrayType(SPAN))
def expression_spans_between(text: pd.Series, target: pd.Series, first: pd.Series, stop: pd.Series) -> pd.Series:
    """Those ``expression_spans`` that lie between two offsets; null without these, and then the text is not searched."""
    asked = first.notna() & stop.notna()
    found = expression_spans.func(text.where(asked, None), target)
    return pd.Series([None if s is None else [x for x in s if x["start"] >= a and x["end"] <= b] for s, a, b in zip(found, first, stop)], dtype="object")


@F.pandas_udf(T.DoubleType())
def similarity(left: pd.Series, right: pd.Series) -> pd.Series:
    """Ratcliff/Obershelp ratio; null if a side is null."""
    return pd.Series([None if pd.isna(a) or pd.isna(b) else SequenceMatcher(None, a, b).ratio() for a, b in zip(left, right)], dtype="float64")


@F.pandas_udf(T.ArrayType(EDIT))
def token_diff(left: pd.Series, right: pd.Series) -> pd.Series:
    """Edits (other than equal stretches) that turn one token list into another."""

    def one(a, b):
        if a is None or b is None:
            return None
        codes = SequenceMatcher(None, list(a), list(b), autojunk=False).get_opcodes()
        return [{"tag": t, "i1": i, "i2": j, "j1": k, "j2": m} for t, i, j, k, m in codes if t != "equal"]

    return pd.Series([one(a, b) for a, b in zip(left, right)])


OPERATION = T.StructType([T.StructField("kind", T.StringType()), *[T.StructField(n, T.IntegerType()) for n in ("i1", "i2", "j1", "j2")]])


def longest_chain(a: list, b: list) -> list[tuple[int, int]]:
    """The points (i, j) of a longest rising chain of equal tokens (null equals null): of several, the one whose last point comes first by (i, j), and so on back.

    Hunt and Szymanski's method: the length of the longest chain that ends in a point is found by
    bisection among the least j of each length so far. Of each length only points with a j below
    all before are kept, as one of them is the first that any later point can follow. Time grows
    with the number of matching positions times its logarithm, memory with the points kept.
    """
    places: dict = {}
    for j, y in enumerate(b):
        places.setdefault(y, []).append(j)
    least: list[int] = []
    kept: list[list[tuple[int, int]]] = []  # by length: j falls from point to point
    for i, x in enumerate(a):
        for j in reversed(places.get(x, ())):
            at = bisect_left(least, j)
            if at == len(least):
                least.append(j)
                kept.append([(i, j)])
            elif j < least[at]:
                least[at] = j
                if kept[at][-1][0] == i:
                    kept[at].pop()  # of one i the lowest j comes first
                kept[at].append((i, j))
    chain: list[tuple[int, int]] = []
    for points in reversed(kept):
        chain.append(points[bisect_right(points, -chain[-1][1], key=lambda p: -p[1])] if chain else points[0])
    return chain[::-1]


def operations(a: list, b: list) -> list[tuple[str, int, int, int, int]]:
    """(kind, i1, i2, j1, j2) of what lies between the points of the longest chain; one block that only moved is one operation."""
    room = min(len(a), len(b))
    head = next((i for i in range(room) if a[i] != b[i]), room)
    tail = next((i for i in range(room - head) if a[-1 - i] != b[-1 - i]), room - head)
    stop, end = len(a) - tail, len(b) - tail
    made, at, to = [], head, head
    for i, j in [(i + head, j + head) for i, j in longest_chain(a[head:stop], b[head:end])] + [(stop, end)]:
        if at < i or to < j:
            made.append(("insertion" if at == i else "deletion" if to == j else "substitution", at, i, to, j))
        at, to = i + 1, j + 1
    if sorted(o[0] for o in made) == ["deletion", "insertion"]:
        (_, i1, i2, _, _), (_, _, _, j1, j2) = sorted(made)
        if a[i1:i2] == b[j1:j2]:
            return [("move", i1, i2, j1, j2)]
    return made


@F.pandas_udf(T.ArrayType(OPERATION))
def edit_operations(left: pd.Series, right: pd.Series) -> pd.Series:
    """``operations`` of two token lists; null if a side is null."""
    return pd.Series([None if a is None or b is None else [dict(zip(OPERATION.names, o)) for o in operations(list(a), list(b))] for a, b in zip(left, right)])


@F.pandas_udf(T.BooleanType())
def one_block_moved(left: pd.Series, right: pd.Series) -> pd.Series:
    """Whether one contiguous block of tokens was moved and nothing else changed.

    Without what both have at either end, one list must be a rotation of the other.
    """

    def one(a, b):
        if a is None or b is None:
            return None
        a, b = list(a), list(b)
        if len(a) != len(b) or a == b:
            return False
        start = next(i for i in range(len(a)) if a[i] != b[i])
        stop = len(a) - next(i for i in range(len(a)) if a[-1 - i] != b[-1 - i])
        x, y = a[start:stop], b[start:stop]
        return any(x[k:] + x[:k] == y for k in range(1, len(x)))

    return pd.Series([one(a, b) for a, b in zip(left, right)], dtype="object")


@F.pandas_udf(T.ArrayType(T.StringType()))
def display_lines(text: pd.Series) -> pd.Series:
    """Text wrapped to 72 columns, paragraph by paragraph."""
    import textwrap

    return text.map(lambda t: [x for p in t.split("\n") for x in (textwrap.wrap(p, 72, break_long_words=False, break_on_hyphens=False) or [""])], na_action="ignore")


PARAGRAPH = T.StructType([T.StructField("body", T.StringType()), T.StructField("starts", T.ArrayType(T.IntegerType())), T.StructField("lines", T.ArrayType(T.StringType())), T.StructField("before", T.IntegerType())])
#: White space as Unicode has it; Python's own class has four more controls.
BLANKS = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
PARAGRAPH_GAP = re.compile("\n[ \t\n\x0b\f\r]*\n")


def wrapped(body: str, width: int) -> list[int]:
    """Offsets at which the display lines of a paragraph with single blanks begin; a word longer than a line has its own."""
    at, begun, starts = 0, 0, [0]
    for word in body.split(" "):
        end = at + len(word)
        if end - begun > width and at != begun:
            begun = at
            starts.append(at)
        at = end + 1
    return starts


@F.pandas_udf(T.ArrayType(PARAGRAPH))
def display_paragraphs(text: pd.Series, width: pd.Series) -> pd.Series:
    """The paragraphs of a text (NFC, single blanks), the offsets of their display lines, these lines, and how many come before; null for null."""

    def one(t, width):
        plain = unicodedata.normalize("NFC", t).replace("\r\n", "\n").replace("\r", "\n")
        out, before = [], 0
        for body in (BLANKS.sub(" ", p).strip(" ") for p in PARAGRAPH_GAP.split(plain)):
            if body:
                starts = wrapped(body, width)
                lines = [body[s : e - 1] for s, e in zip(starts, [*starts[1:], len(body) + 1])]
                out.append({"body": body, "starts": starts, "lines": lines, "before": before})
                before += len(lines)
        return out

    return pd.Series([None if t is None else one(t, w) for t, w in zip(text, width)], dtype="object")


def _walk(value, path: str = "$"):
    """(path, key, value) of every key at any depth."""
    if isinstance(value, dict):
        for key, inner in value.items():
            yield f"{path}.{key}", key, inner
            yield from _walk(inner, f"{path}.{key}")
    elif isinstance(value, list):
        for i, inner in enumerate(value):
            yield from _walk(inner, f"{path}[{i}]")


def _parsed(text: str | None):
    import json

    try:
        return json.loads(text) if text is not None else None
    except ValueError:
        return None


def keyed_values(*names: str):
    """Texts that stand under one of the names at any depth of a JSON document; none if it doesn't parse."""

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def values(documents: pd.Series) -> pd.Series:
        return documents.map(lambda d: [v for _, key, v in _walk(_parsed(d)) if key in names and isinstance(v, str)])

    return values


def paths_of(*names: str):
    """Paths at which one of the names stands as a key, at any depth of a JSON document."""

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def paths(documents: pd.Series) -> pd.Series:
        return documents.map(lambda d: [path for path, key, _ in _walk(_parsed(d)) if key in names])

    return paths


@F.pandas_udf(T.StringType())
def json_in_text(texts: pd.Series) -> pd.Series:
    """The JSON value in noisy text, in canonical form; null if there is none.

    The whole text is tried first, then fenced blocks; a text under ``result`` is searched in
    turn, and ``structured_output`` is unwrapped. Failing that, the first object or array with
    which the text ends counts.
    """
    import json
    import re

    fence = re.compile(r"```(?:json)?\s*(.*?)\s*```", re.IGNORECASE | re.DOTALL)

    def find(text: str):
        text = text.strip()
        for part in (text, *fence.findall(text)):
            try:
                value = json.loads(part)
            except ValueError:
                continue
            if isinstance(value, dict) and isinstance(value.get("result"), str) and (inner := find(value["result"])):
                return inner
            return (value["structured_output"],) if isinstance(value, dict) and "structured_output" in value else (value,)
        for start in re.finditer(r"[\[{]", text):
            try:
                return (json.loads(text[start.start() :]),)
            except ValueError:
                continue
        return None

    def one(text):
        found = None if text is None else find(text)
        return None if found is None else json.dumps(found[0], sort_keys=True, separators=(",", ":"), ensure_ascii=False)

    return texts.map(one)
