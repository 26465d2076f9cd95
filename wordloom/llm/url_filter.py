"""Operator 1: URL filter with a weighted vocabulary.

Host and path rules decide first. Every other URL is scanned once by an Aho-Corasick automaton
for the terms of a vocabulary; a hit counts only if no ASCII letter or digit touches it. One
strict term blocks the URL, and so do several distinct soft terms whose weights add up to enough.

A vocabulary is a parameter, read from a table of terms (term, weight; a null weight makes a term
strict) or given in code. The one below is small and stands in for the lists that a user has.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower

STRICT = ("porn", "porno", "xxx", "hentai", "camgirls", "escorts", "warez", "phishing", "keygen", "spam-farm", "link-farm", "sex-chat")
#: Weight 2: hardly met on other pages; weight 1: only telling together with others.
SOFT = {"sex": 2, "nude": 2, "casino": 2, "betting": 2, "poker": 2, "viagra": 2, "torrent": 2, "adult": 1, "slots": 1, "pills": 1, "payday": 1, "crack": 1, "replica": 1, "spam": 1, "farm": 1, "cheap": 1}
#: A vocabulary goes to every task with the function that scans for it; larger ones are refused.
MOST_TERMS = 1_000_000
#: (verdict, host and path), the longest that fits wins.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


@dataclass(frozen=True)
class Vocabulary:
    strict: tuple[str, ...] = STRICT
    soft: dict[str, int] = field(default_factory=lambda: dict(SOFT))
    soft_weight: int = 3  # blocked from this sum of the weights of distinct soft terms,
    soft_terms: int = 2  # and from so many of them

    @classmethod
    def of_table(cls, terms: DataFrame, **limits) -> "Vocabulary":
        """A vocabulary from a table (term, weight). Terms are lower-cased; null and empty ones are left out; of repeated ones the strictest holds."""
        lowered = terms.select(ascii_lower(F.col("term")).alias("term"), F.col("weight").cast("int").alias("weight")).where("length(term) > 0")
        each = lowered.groupBy("term").agg(F.max(F.col("weight").isNull()).alias("strict"), F.max("weight").alias("weight")).limit(MOST_TERMS + 1).collect()
        if len(each) > MOST_TERMS:
            raise ValueError(f"a vocabulary has {MOST_TERMS} terms at most")
        return cls(tuple(sorted(r["term"] for r in each if r["strict"])), {r["term"]: r["weight"] for r in each if not r["strict"]}, **limits)


def _scan(vocabulary: Vocabulary):
    held: list = []

    def automaton():
        if not held:
            import ahocorasick

            held.append(ahocorasick.Automaton())
            for term in (*vocabulary.soft, *vocabulary.strict):  # of a term that is both, strict holds
                held[0].add_word(term, (term, len(term)))
            held[0].make_automaton()
        return held[0]

    def joins(c: str) -> bool:
        return c.isascii() and c.isalnum()

    @F.pandas_udf("n_strict long, n_soft long, soft_weight long")
    def scan(urls: pd.Series) -> pd.DataFrame:
        machine, strict, rows = automaton(), frozenset(vocabulary.strict), []
        for url in urls:
            hits, soft = 0, set()
            for end, (term, size) in machine.iter(url) if url else ():
                if (end + 1 < len(url) and joins(url[end + 1])) or (end >= size and joins(url[end - size])):
                    continue
                if term in strict:
                    hits += 1
                else:
                    soft.add(term)
            rows.append((hits, len(soft), sum(vocabulary.soft[x] for x in soft)))
        return pd.DataFrame(rows, columns=["n_strict", "n_soft", "soft_weight"])

    return scan


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both are empty for a null url and for one without ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host, path = (F.coalesce(F.regexp_extract(url, pattern, i), F.lit("")) for i in (1, 2))
    return ascii_lower(host), path


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest rule that fits; both null if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: len(r[1])):  # the longest is asked first
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def url_filter(pages: DataFrame, rules=RULES, vocabulary: Vocabulary = Vocabulary(), key: str = "page_id") -> DataFrame:
    """A verdict for each row of ``pages`` (the key, url).

    A null or empty url has empty host and path, meets no rule and no term, and is allowed. Of
    rules of equal length that fit, the one named last holds.
    Repeated rows are judged each by itself; other columns are not read; an empty table gives
    an empty result.
    """
    host, path = host_and_path(F.col("url"))
    split = pages.select(key, "url", host.alias("host"), path.alias("path"))
    rule, ruled = rule_for(F.col("host"), F.col("path"), rules)
    judged = split.select(key, "host", "path", rule.alias("rule"), ruled.alias("ruled"), _scan(vocabulary)(ascii_lower(F.col("url"))).alias("found"))
    enough = (F.col("found.n_soft") >= vocabulary.soft_terms) & (F.col("found.soft_weight") >= vocabulary.soft_weight)
    blocked = (F.col("found.n_strict") > 0) | enough
    return judged.select(key, "host", "path", "rule", F.coalesce("ruled", F.when(blocked, "block").otherwise("allow")).alias("verdict"), "found.n_strict", "found.n_soft", "found.soft_weight")


def oracle(rules=RULES, vocabulary: Vocabulary = Vocabulary()) -> str:
    """The same rows by DuckDB."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

    def hits(term: str) -> str:  # a character between two hits may bound both, so it is doubled
        doubled = r"regexp_replace(u, '([^a-z0-9])', '\1\1', 'g')"
        plain = "".join(c * 2 if not c.isalnum() else c for c in term)
        return f"len(regexp_extract_all({doubled}, '(^|[^a-z0-9]){plain}([^a-z0-9]|$)'))"

    fits = {t: f"(host = '{t.split('/')[0]}' OR ends_with(host, '.{t.split('/')[0]}')) AND starts_with(path, '/{t.split('/', 1)[1]}')" for _, t in rules}
    longest = sorted(rules, key=lambda r: -len(r[1]))
    strict = " + ".join(hits(t) for t in vocabulary.strict)
    soft = " + ".join(f"({hits(t)} > 0)::BIGINT" for t in vocabulary.soft)
    weight = " + ".join(f"({hits(t)} > 0)::BIGINT * {w}" for t, w in vocabulary.soft.items())
    return f"""
WITH split AS (
  SELECT page_id, coalesce(translate(url, '{upper}', '{lower}'), '') AS u,
         coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), '{upper}', '{lower}'), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
judged AS (
  SELECT page_id, host, path, CASE {' '.join(f"WHEN {fits[t]} THEN '{t}'" for _, t in longest)} END AS rule,
         CASE {' '.join(f"WHEN {fits[t]} THEN '{k}'" for k, t in longest)} END AS ruled,
         ({strict})::BIGINT AS n_strict, ({soft})::BIGINT AS n_soft, ({weight})::BIGINT AS soft_weight
  FROM split)
SELECT page_id, host, path, rule,
       coalesce(ruled, CASE WHEN n_strict > 0 OR n_soft >= {vocabulary.soft_terms} AND soft_weight >= {vocabulary.soft_weight} THEN 'block' ELSE 'allow' END) AS verdict,
       n_strict, n_soft, soft_weight
FROM judged"""
