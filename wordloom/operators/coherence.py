"""How well a short span of a sentence holds together, by the classes of its words and the word after it.

Word classes come from a lexicon table (word, class) and from endings; a word may have several. A
span's score is that of the first shape it has, less what its cuts cost. Shapes and cuts are rows of
two tables, of conditions over the classes at the span's ends, and one evaluator runs any such table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.tables import first_of, sum_of
from .audit import CLAUSE_MARKERS, CONJUNCTIONS

# Words by class.
DETERMINERS = (
    "a an the this that these those each every either neither some any no another both many much few several all enough "
    "one two three four five my your his her its our their"
).split()
PREPOSITIONS = (
    "about above across after against along among around at before behind below beneath beside between beyond by despite during except for "
    "from in inside into near of off on onto over per since through throughout to toward under until up upon via with within without"
).split()
AUXILIARIES = "am are be been being can could did do does had has have is may might must shall should was were will would".split()
ADVERBS = "already always carefully clearly early earlier especially even ever often only quite rather recently seldom simply still then there together usually very well later".split()
ADJECTIVES = (
    "ancient annual available coastal chemical careful current detailed different direct early every extended familiar fragile gradual high independent intense "
    "local long-term mechanical mechanized natural northern regional remote revised scarce seasonal several similar small steep stellar structural terraced "
    "unusual unstable warm wet following first next neighboring public latest monthly subtle"
).split()
VERBS = (
    "adopt adopted altered approved compare compared contains clarify changes detect developed determined examines expect find found gathered identifies include "
    "includes increases limit limits measure measures monitor observed opens preserves plans produce produced reaches records reduce reduced repeated require "
    "requires restore reviewed shows studying tested tests transport withstand were was"
).split()
LEXICON = {"determiner": DETERMINERS, "preposition": PREPOSITIONS, "auxiliary": AUXILIARIES, "conjunction": [*CONJUNCTIONS, "yet", "so"], "marker": CLAUSE_MARKERS, "adverb": ADVERBS, "adjective": ADJECTIVES, "verb": VERBS}
# Endings by class.
ENDINGS = {"adverb": ("ly",), "adjective": ("able", "ible", "al", "ary", "ful", "ic", "ive", "less", "ous", "ed", "ing"), "verb": ("ed", "ing", "s")}
FUNCTION_WORDS = ("determiner", "preposition", "auxiliary", "conjunction", "marker")
BAD_LAST = ("preposition", "determiner", "auxiliary", "conjunction")

# Scores of a single word, of several words, and what cuts cost.
ALONE, TOGETHER = 0.95, 0.72
SINGLE = {"determiner": 0.05, "preposition": 0.12, "marker": 0.12, "auxiliary before verb": 0.04, "auxiliary": 0.16, "conjunction": 0.08, "adjective before noun": 0.30}
SHAPES = {"determined noun": 1.42, "adjective noun": 1.38, "preposition noun": 1.34, "auxiliary verb": 1.30, "adverb modified": 1.26, "verb object": 1.20, "noun noun": 1.08}
CUTS = {"bad last": 0.82, "preposition alone": 0.78, "noun preposition": 0.55, "adjective cut from noun": 0.72, "auxiliary cut from verb": 0.75, "verb preposition": 0.35}


def lexicon(spark: SparkSession, words: dict[str, list[str]] = LEXICON) -> DataFrame:
    """(word, classes) of every word of the lists."""
    rows = [(w, name) for name, listed in words.items() for w in listed]
    return spark.createDataFrame(rows, "word string, class string").groupBy("word").agg(F.collect_set("class").alias("listed"))


def word_classes(word: Column, listed: Column) -> Column:
    """All classes of a lower-cased word: those of the lexicon, those of its endings, and noun where nothing speaks against it."""
    known = F.coalesce(listed, F.array().cast("array<string>"))
    ends = lambda name: F.array_contains(known, name) | _any([word.endswith(e) for e in ENDINGS[name]])
    verb = F.array_contains(known, "verb") | word.endswith("ed") | word.endswith("ing") | (word.endswith("s") & ~F.array_contains(known, "determiner"))
    noun = ~_any([F.array_contains(known, c) for c in FUNCTION_WORDS]) & ~ends("adverb") & ~ends("adjective")
    found = [F.when(ends("adverb"), "adverb"), F.when(ends("adjective"), "adjective"), F.when(verb, "verb"), F.when(noun, "noun")]
    return F.array_union(F.filter(known, lambda c: c.isin(*FUNCTION_WORDS)), F.array_compact(F.array(*found)))


def _any(conditions: list[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


def classified(sentences: DataFrame, key: str, words: str, listed: DataFrame) -> DataFrame:
    """``sentences`` with ``classes``, an array of classes for each word; the lexicon is joined word by word."""
    each = sentences.select(key, F.posexplode(words).alias("i", "w")).withColumn("word", F.lower("w"))
    told = each.join(F.broadcast(listed), "word", "left").select(key, F.struct("i", word_classes(F.col("word"), F.col("listed")).alias("c")).alias("x"))
    grouped = told.groupBy(key).agg(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["c"]).alias("classes"))
    return sentences.join(grouped, key, "left").withColumn("classes", F.coalesce("classes", F.array().cast("array<array<string>>")))


def score(classes: Column, start: Column, end: Column) -> Column:
    """The coherence of the span of words from ``start`` to ``end`` (exclusive), given the classes of all words of its sentence."""
    span = F.slice(classes, start + 1, end - start)
    first, second, last, after = F.get(span, F.lit(0)), F.get(span, F.lit(1)), F.element_at(span, -1), F.get(classes, end)
    is_: Callable[[Column, str], Column] = lambda word, name: F.coalesce(F.array_contains(word, name), F.lit(False))
    rest = F.slice(span, 2, F.greatest(end - start - 1, F.lit(1)))
    object_ = F.exists(rest, lambda w: F.array_contains(w, "noun"))
    single = {
        "determiner": is_(first, "determiner"),
        "preposition": is_(first, "preposition"),
        "marker": is_(first, "marker"),
        "auxiliary before verb": is_(first, "auxiliary") & is_(after, "verb"),
        "auxiliary": is_(first, "auxiliary"),
        "conjunction": is_(first, "conjunction"),
        "adjective before noun": is_(first, "adjective") & is_(after, "noun"),
    }
    shapes = {
        "determined noun": is_(first, "determiner") & object_,
        "adjective noun": is_(first, "adjective") & is_(second, "noun"),
        "preposition noun": is_(first, "preposition") & object_,
        "auxiliary verb": is_(first, "auxiliary") & (is_(second, "verb") | is_(second, "auxiliary")),
        "adverb modified": is_(first, "adverb") & (is_(second, "adjective") | is_(second, "verb")),
        "verb object": is_(first, "verb") & object_,
        "noun noun": is_(first, "noun") & is_(second, "noun"),
    }
    cuts = {
        "bad last": _any([is_(last, c) for c in BAD_LAST]),
        "preposition alone": is_(first, "preposition") & (~object_ | F.forall(rest, lambda w: F.array_contains(w, "adjective"))),
        "noun preposition": is_(first, "noun") & is_(last, "preposition"),
        "adjective cut from noun": is_(last, "adjective") & is_(after, "noun") & ~(is_(first, "auxiliary") & is_(last, "verb")),
        "auxiliary cut from verb": is_(last, "auxiliary") & is_(after, "verb"),
        "verb preposition": is_(first, "verb") & is_(last, "preposition") & after.isNotNull(),
    }
    several = F.greatest(F.lit(0.0), F.round(first_of(SHAPES, shapes, TOGETHER) - sum_of(CUTS, cuts), 4))
    return F.when(end - start == 1, first_of(SINGLE, single, ALONE)).when(end > start, several)
