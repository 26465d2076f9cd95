"""Operator 5: personal data by patterns, checksums and context.

Patterns propose spans; validators confirm them (Luhn for cards, mod-97 for IBANs, value ranges
and digit counts); words near a span raise its score. Spans of the base kinds (email, ip, card,
phone) stand once they are valid. The other kinds need a score of at least THRESHOLD: an IBAN
gets it from its checksum; a social security number, a date of birth and a passport number only
with a word like "ssn", "born" or "passport" nearby, as a whole word.

DataFrame functions only: the gaps between matches come from ``split``, the matches themselves
from ``regexp_extract_all``, and their lengths add up to positions in code points. The patterns
are written so that a long run of digits or letters is scanned once: a match may start only
where its run starts, and runs are never given back. Time is in proportion to the text also
where a text has very many spans: sums run over chunks of matches, since an array that grows by
one element at a time is copied each time, and words near a span are looked up in blocks of the
text, since a position in code points is sought from the start of its string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import unused

BASE = ("email", "ip", "card", "phone")
EXTRA = ("iban", "ssn", "birth", "passport")
THRESHOLD = 0.5
NEAR = 40
CONTEXT = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "address", "host", "server"),
    "card": ("card", "visa", "mastercard", "credit", "payment"),
    "phone": ("phone", "call", "tel", "mobile", "fax"),
    "iban": ("iban", "account", "bank", "konto", "compte"),
    "ssn": ("ssn", "social security", "social-security"),
    "birth": ("born", "birth", "birthday", "birthdate", "dob", "geboren", "geburtsdatum", "né", "née", "naissance", "nacido", "nacida", "nacimiento"),
    "passport": ("passport", "reisepass", "passeport", "pasaporte"),
}
#: Score before context; a context word adds CONTEXT_SCORE.
SCORE = {"email": 0.8, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.7, "ssn": 0.3, "birth": 0.3, "passport": 0.3}
CONTEXT_SCORE = 0.2

_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # A whole chain of digits joined by single blanks or hyphens, if it has 13 to 19 of them.
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?+[0-9]){12,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}+(?![A-Za-z0-9])",
    # Areas 000, 666 and 9xx, group 00 and serial 0000 are never given out.
    "ssn": r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
    "birth": r"(?<![0-9-])(?:19|20)[0-9]{2}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12][0-9]|3[01])(?![0-9-])",
    "passport": r"(?<![A-Za-z0-9])[A-Z][0-9]{8}(?![A-Za-z0-9])",
}
#: A text without this character has no match, which is far cheaper to see.
NEEDS = {"email": "@", "ip": ".", "phone": "+", "ssn": "-", "birth": "-"}

#: Matches in a chunk of a running sum, and code points in a block of a text.
CHUNK = 256
BLOCK = 1024
_SPANS = "array<struct<start:int,end:int,text:string>>"


def once(value: Column, use) -> Column:
    """``use(value)``, with the value made once however often it is used, also inside of lambdas."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running(items: Column, state: Column, emitted: str, step) -> Column:
    """What ``step(state, item)``, a pair (state, out), puts out for each of ``items`` in turn.

    ``emitted`` is the type of the array of all outs. A chunk's outs are gathered before they
    are added to those of the chunks before it, so few of them are copied often.
    """
    none = F.array().cast(emitted)

    def add(held, item):
        told = step(held["state"], item)
        return F.struct(told[0].alias("state"), F.concat(held["out"], F.array(told[1])).alias("out"))

    def add_chunk(held, chunk):
        done = F.aggregate(chunk, F.struct(held["state"].alias("state"), none.alias("out")), add)
        return once(done, lambda d: F.struct(d["state"].alias("state"), F.concat(held["out"], F.array(d["out"])).alias("out")))

    def all_chunks(given):
        chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(given) - 1) / CHUNK).cast("int")), lambda i: F.slice(given, i * CHUNK + 1, CHUNK))
        zero = F.struct(state.alias("state"), F.array().cast(f"array<{emitted}>").alias("out"))
        return F.flatten(F.aggregate(chunks, zero, add_chunk, lambda held: held["out"]))

    return once(items, lambda given: F.when(F.size(given) > 0, all_chunks(given)).otherwise(none))


def blocks(text: Column) -> Column:
    """The text in parts of BLOCK code points."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))


def part_of(blocks_: Column, start: Column, end: Column) -> Column:
    """The text from ``start`` to ``end`` (code points), from the blocks in which it lies."""
    first = F.floor(start / BLOCK).cast("int")
    held = F.array_join(F.slice(blocks_, first + 1, F.floor(F.greatest(end - 1, start) / BLOCK).cast("int") - first + 1), "")
    return F.substring(held, start - first * BLOCK + 1, end - start)


def located(text: Column, found: Column, pattern: str) -> Column:
    """Matches with their half-open positions, from the matches and the gaps before them."""

    def step(at, pair):
        start = at + F.length(pair["gap"])
        end = start + F.length(pair["text"])
        return end, F.struct(start.alias("start"), end.alias("end"), pair["text"].alias("text"))

    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))  # the last one stands after all matches
    pairs = F.arrays_zip(gaps.alias("gap"), found.alias("text"))
    return F.when(F.size(found) > 0, running(pairs, F.lit(0), _SPANS, step)).otherwise(F.array().cast(_SPANS))


def luhn(text: Column) -> Column:
    digits = F.reverse(F.regexp_replace(text, "[^0-9]", ""))

    def step(total, i):
        d = F.substring(digits, i, 1).cast("int")
        twice = d * 2 - F.when(d > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), step) % 10 == 0


def mod97(text: Column) -> Column:
    """The ISO 7064 remainder of an IBAN is 1; letters count as 10 to 35."""
    turned = F.concat(F.substring(text, 5, 64), F.substring(text, 1, 4))

    def step(rest, i):
        c = F.substring(turned, i, 1)
        value = F.when(c < "A", F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
        return (rest * F.when(value < 10, 10).otherwise(100) + value) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step) == 1


def _valid(kind: str, span: Column) -> Column:
    text = span["text"]
    if kind == "ip":
        return F.forall(F.split(text, r"\."), lambda p: p.rlike(r"^0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})$"))
    if kind == "card":
        return luhn(text)
    if kind == "phone":
        return F.length(F.regexp_replace(text, "[^0-9]", "")).between(9, 15)
    if kind == "iban":
        return mod97(text)
    return F.lit(True)


def _test(kind: str):
    return lambda span: _valid(kind, span)


def _is(kind: str):
    return lambda span: span["kind"] == kind


def _context(kind: str) -> str:
    """A pattern, in a form that other engines read too, for any context word of a kind as a whole word of a lower-cased text."""
    return f"(^|[^a-z0-9])({'|'.join(CONTEXT[kind])})($|[^a-z0-9])"


def _scored(kind: str, blocks_: Column, spans: Column) -> Column:
    def one(s):
        before = part_of(blocks_, F.greatest(s["start"] - NEAR, F.lit(0)), s["start"])
        after = part_of(blocks_, s["end"], s["end"] + NEAR)
        around = F.lower(F.concat(before, F.lit(" "), after))
        score = F.lit(SCORE[kind]) + F.when(around.rlike(_context(kind)), CONTEXT_SCORE).otherwise(0.0)
        return F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), score.alias("score"))

    return F.transform(spans, one)


def find_pii(docs: DataFrame, name: str = "pii") -> DataFrame:
    """``docs`` with a column ``name``: kind, start, end, score of each span, by kind and start.

    Positions are code points, the end is exclusive. Spans of one kind never overlap; those of
    different kinds may. Null and empty texts have no spans; every row is taken by itself.
    """
    names = docs.columns
    text = F.coalesce(F.col("text"), F.lit(""))
    kinds = (*BASE, *EXTRA)
    found_, at_, in_ = ({k: unused(names, f"_{stage}_{k}") for k in kinds} for stage in ("found", "at", "in"))
    none, blocks_ = F.array().cast("array<string>"), unused(names, "_blocks")

    def proposed(kind: str) -> Column:
        found = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))
        return F.when(text.contains(NEEDS[kind]), found).otherwise(none) if kind in NEEDS else found

    step = docs.select(*names, *[proposed(k).alias(found_[k]) for k in kinds])
    step = step.select(*names, *[F.filter(located(text, F.col(found_[k]), PATTERNS[k]), _test(k)).alias(at_[k]) for k in kinds])
    step = step.select("*", F.when(F.greatest(*[F.size(at_[k]) for k in kinds]) > 0, blocks(text)).alias(blocks_))
    step = step.select(*names, *[_scored(k, F.col(blocks_), F.col(at_[k])).alias(in_[k]) for k in kinds])
    parts = [F.col(in_[k]) for k in BASE] + [F.filter(in_[k], lambda s: s["score"] >= THRESHOLD) for k in EXTRA]
    return step.select(*names, F.concat(*parts).alias(name))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds, digest of the base spans, all spans and their scores (in hundredths), for each row."""
    found = find_pii(docs.select("doc_id", "text")).select("doc_id", "pii")
    counts = [F.size(F.filter("pii", _is(k))).cast("long").alias(f"n_{k}") for k in BASE]
    base = F.filter("pii", lambda s: s["kind"].isin(*BASE))
    scores = F.array_join(F.transform("pii", lambda s: F.round(s["score"] * 100).cast("int").cast("string")), ",").alias("scores")
    return found.select("doc_id", *counts, F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("pii")).alias("spans"), scores)


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with each span replaced by its kind in angle brackets.

    Of spans that overlap, the one that starts first gives the mark, and all are covered. Texts
    without spans, null ones included, stay as they are; n_chars follows the text if present.
    """
    names = docs.columns
    pii, held = unused(names, "pii"), unused(names, "_blocks")
    found = find_pii(docs, pii).withColumn(held, F.when(F.size(pii) > 0, blocks(F.col("text"))))
    ordered = F.array_sort(F.transform(pii, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def step(at, s):
        mark = F.concat(part_of(F.col(held), at, s["start"]), F.lit("<"), F.upper(s["kind"]), F.lit(">"))
        return F.greatest(at, s["end"]), F.when(s["start"] >= at, mark).otherwise("")

    pieces = running(ordered, F.lit(0), "array<string>", step)
    tail = part_of(F.col(held), F.array_max(F.transform(pii, lambda s: s["end"])), F.length("text"))
    masked = F.array_join(F.concat(pieces, F.array(tail)), "")
    changed = found.withColumn("text", F.when(F.size(pii) > 0, masked).otherwise(F.col("text"))).select(*names)
    if "n_chars" in names:
        kind = dict(docs.dtypes)["n_chars"]
        changed = changed.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(kind))
    return changed.select(*names)


def oracle() -> str:
    """The same rows by DuckDB; chains and runs are cut out whole and tested as such."""
    plain = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
        "iban": r"[A-Za-z0-9]+",
        "ssn": r"[0-9-]+",
        "birth": r"[0-9-]+",
        "passport": r"[A-Za-z0-9]+",
    }
    digits = "regexp_replace(m, '[^0-9]', '', 'g')"
    luhn_sum = f"list_sum(list_transform(range(1, length({digits}) + 1), lambda i: CASE WHEN i % 2 = 0 THEN CASE WHEN reverse({digits})[i]::INT > 4 THEN reverse({digits})[i]::INT * 2 - 9 ELSE reverse({digits})[i]::INT * 2 END ELSE reverse({digits})[i]::INT END))"
    turned = "(substring(m, 5) || substring(m, 1, 4))"
    value = "CASE WHEN c < 'A' THEN ascii(c) - 48 ELSE ascii(c) - 55 END"
    rest = f"list_reduce(list_concat([0], list_transform(string_split({turned}, ''), lambda c: ({value})::INT)), lambda a, b: (a * CASE WHEN b < 10 THEN 10 ELSE 100 END + b) % 97)"
    valid = {
        "email": "true",
        "ip": "list_bool_and(list_transform(string_split(m, '.'), lambda p: regexp_full_match(p, '0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})')))",
        "card": f"CASE WHEN length({digits}) BETWEEN 13 AND 19 THEN {luhn_sum} % 10 = 0 ELSE false END",
        "phone": f"length({digits}) BETWEEN 9 AND 15",
        "iban": f"CASE WHEN regexp_full_match(m, '[A-Z]{{2}}[0-9]{{2}}[A-Z0-9]{{11,30}}') THEN {rest} = 1 ELSE false END",
        "ssn": "regexp_full_match(m, '[0-9]{3}-[0-9]{2}-[0-9]{4}') AND substring(m, 1, 3) NOT IN ('000', '666') AND substring(m, 1, 1) <> '9' AND substring(m, 5, 2) <> '00' AND substring(m, 8) <> '0000'",
        "birth": "regexp_full_match(m, '(19|20)[0-9]{2}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])')",
        "passport": "regexp_full_match(m, '[A-Z][0-9]{8}')",
    }
    parts = []
    for n, kind in enumerate((*BASE, *EXTRA)):
        score = f"{round(SCORE[kind] * 100)} + CASE WHEN regexp_matches(ctx, '{_context(kind)}') THEN {round(CONTEXT_SCORE * 100)} ELSE 0 END"
        enough = f"AND {score} >= {round(THRESHOLD * 100)}" if kind in EXTRA else ""
        parts.append(f"""
SELECT r, {n} AS k, '{kind}' AS kind, s, e, {score} AS score FROM (
  SELECT r, m, s, s + length(m) AS e,
         lower(substring(text, greatest(s - {NEAR}, 0) + 1, least(s, {NEAR})) || ' ' || substring(text, s + length(m) + 1, {NEAR})) AS ctx
  FROM (SELECT r, text, ms[i] AS m, (list_sum(list_transform(gs[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0))::BIGINT AS s
        FROM (SELECT r, text, ms, gs, unnest(range(1, len(ms) + 1)) AS i
              FROM (SELECT r, text, regexp_extract_all(text, '{plain[kind]}') AS ms, string_split_regex(text, '{plain[kind]}') AS gs FROM d)))
) WHERE ({valid[kind]}) {enough}""")
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
f AS ({' UNION ALL '.join(parts)}),
g AS (SELECT r, {', '.join(f"count(*) FILTER (kind = '{k}')::BIGINT AS n_{k}" for k in BASE)},
        string_agg(kind || ':' || s || ':' || e, ',' ORDER BY k, s) FILTER (k < {len(BASE)}) AS base,
        string_agg(kind || ':' || s || ':' || e, ',' ORDER BY k, s) AS spans, string_agg(score, ',' ORDER BY k, s) AS scores FROM f GROUP BY r)
SELECT doc_id, {', '.join(f"coalesce(n_{k}, 0) AS n_{k}" for k in BASE)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(scores, '') AS scores
FROM d LEFT JOIN g USING (r)"""
