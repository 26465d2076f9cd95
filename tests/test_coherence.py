"""Span coherence against a plain version, and on sentences with known scores."""

from pyspark.sql import functions as F

from wordloom.functions import text as tx
from wordloom.operators import coherence as co
from wordloom.plans import catalogue

WORDS = {name: set(words) for name, words in co.LEXICON.items()}


def has(word, name):
    if word is None:
        return False
    if name == "noun":
        return not any(word in WORDS[c] for c in co.FUNCTION_WORDS) and not has(word, "adverb") and not has(word, "adjective")
    if name == "verb":
        return word in WORDS["verb"] or word.endswith(("ed", "ing")) or (word.endswith("s") and word not in WORDS["determiner"])
    return word in WORDS[name] or word.endswith(co.ENDINGS.get(name, ("\0",)))


def plain(words, start, end):
    span, after = words[start:end], words[end] if end < len(words) else None
    a, z, rest = span[0], span[-1], span[1:]
    noun_in_rest = any(has(w, "noun") for w in rest)
    if len(span) == 1:
        if has(a, "determiner"):
            return 0.05
        if has(a, "preposition") or has(a, "marker"):
            return 0.12
        if has(a, "auxiliary"):
            return 0.04 if has(after, "verb") else 0.16
        if has(a, "conjunction"):
            return 0.08
        return 0.30 if has(a, "adjective") and has(after, "noun") else 0.95
    b = span[1]
    shapes = [(1.42, has(a, "determiner") and noun_in_rest), (1.38, has(a, "adjective") and has(b, "noun")), (1.34, has(a, "preposition") and noun_in_rest), (1.30, has(a, "auxiliary") and (has(b, "verb") or has(b, "auxiliary"))), (1.26, has(a, "adverb") and (has(b, "adjective") or has(b, "verb"))), (1.20, has(a, "verb") and noun_in_rest), (1.08, has(a, "noun") and has(b, "noun"))]
    score = next((v for v, ok in shapes if ok), 0.72)
    score -= 0.82 * any(has(z, c) for c in ("preposition", "determiner", "auxiliary", "conjunction"))
    score -= 0.78 * (has(a, "preposition") and (not noun_in_rest or all(has(w, "adjective") for w in rest)))
    score -= 0.55 * (has(a, "noun") and has(z, "preposition"))
    score -= 0.72 * (has(z, "adjective") and has(after, "noun") and not (has(a, "auxiliary") and has(z, "verb")))
    score -= 0.75 * (has(z, "auxiliary") and has(after, "verb"))
    score -= 0.35 * (has(a, "verb") and has(z, "preposition") and after is not None)
    return max(0.0, round(score, 4))


SENTENCES = [
    "Although the observatory records seasonal changes among stellar populations, the calibration of its detectors is carefully tested.",
    "The intense monsoon has altered the soil, and several regional farmers were reviewed by an independent panel without delay.",
    "Those who plan early often gathered small, very steep stones from a long-term project near their village so that nobody would expect it.",
    "of", "was", "was tested", "", "steep", "steep hill that", "will have been",
]


def test_like_a_plain_version(spark):
    rows = spark.createDataFrame(list(enumerate(SENTENCES)), "k int, text string").select("k", tx.found(F.lower("text"), tx.LEXICAL).alias("w"))
    told = co.classified(rows, "k", "w", co.lexicon(spark))
    assert {r.k for r in told.collect()} == set(range(len(SENTENCES)))
    each = told.select("*", F.explode(F.sequence(F.lit(0), F.size("w"))).alias("s")).select("*", F.explode(F.sequence(F.col("s"), F.least(F.col("s") + 5, F.size("w")))).alias("e"))
    got = each.select("k", "w", "s", "e", co.score(F.col("classes"), F.col("s"), F.col("e")).alias("score")).collect()
    scores = set()
    for r in got:
        assert r.score == (plain(r.w, r.s, r.e) if r.e > r.s else None), (r.w[r.s : r.e], r.score)
        scores.add(r.score)
    assert {0.05, 0.12, 0.16, 0.04, 0.08, 0.30, 0.95, 1.42, 1.38, 1.34, 1.30, 1.26, 1.20, 1.08} <= scores


def test_span_coherence(spark, data):
    rows = catalogue.queries()["span_coherence"](spark, data).collect()
    words = {r.item_id: r.w for r in spark.read.parquet(f"{data}/benchmark.parquet").select("item_id", tx.found(F.lower("text"), tx.LEXICAL).alias("w")).collect()}
    assert len(rows) == sum(max(len(w) - k + 1, 0) for w in words.values() for k in range(1, 5))
    for r in rows:
        want = plain(words[r.item_id], r.start, r.stop)
        assert r.score == want and r["class"] == ("CLEARLY_INCOHERENT" if want <= 0 else "BORDERLINE" if want < 0.35 else "COHERENT")
