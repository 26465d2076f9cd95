"""Text measurement as column expressions; nothing here leaves the JVM.

Several word counters exist side by side because they answer different questions: they differ
on hyphens, curly apostrophes, underscores and non-ASCII letters, and must not be unified.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LEXICAL = r"[\p{L}\p{N}]+(?:['’\-][\p{L}\p{N}]+)*"
ASCII_WORD = r"[A-Za-z]+(?:'[A-Za-z]+)?"
WORDISH = r"[\p{L}\p{N}_]+(?:['\-][\p{L}\p{N}_]+)*"
SENTENCE_GAP = r"(?<=[.!?])[\"')\]]*\s+"
SENTENCE_MARK = r"[.!?](?=[\"')\]]?(?:\s|$))"
#: Words that carry no content.
STOPWORDS = (
    "a", "an", "and", "are", "as", "at", "be", "been", "being", "but", "by", "can", "could", "did", "do", "does", "for", "from", "had", "has", "have",
    "he", "her", "hers", "him", "his", "how", "if", "in", "into", "is", "it", "its", "may", "might", "more", "most", "not", "of", "on", "or", "our",
    "she", "should", "so", "some", "such", "than", "that", "the", "their", "them", "then", "there", "these", "they", "this", "those", "to", "was",
    "we", "were", "what", "when", "where", "which", "while", "who", "why", "will", "with", "would", "you", "your",
)
#: From these on a text is flagged.
LONG_WORD = 8
LONG_WORD_RATE = 0.36
SENTENCE_WORDS = 34.0
WORDS_LEAST, WORDS_MOST = 160, 300


def found(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def lexical_tokens(text: Column) -> Column:
    """Runs of letters and digits, with inner apostrophes and hyphens."""
    return found(text, LEXICAL)


def ascii_words(text: Column) -> Column:
    """ASCII words, lower-cased."""
    return F.transform(found(text, ASCII_WORD), F.lower)


def wordish(text: Column) -> Column:
    """Words in which the underscore counts as a letter and the curly apostrophe does not."""
    return found(text, WORDISH)


def blank_words(text: Column) -> Column:
    """Whatever stands between white space."""
    return F.filter(F.split(text, r"\s+"), lambda x: x != "")


def squeezed(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def normalized(text: Column) -> Column:
    """Single blanks, trimmed, lower-cased."""
    return F.lower(squeezed(text))


def sentences(text: Column) -> Column:
    return F.filter(F.split(squeezed(text), SENTENCE_GAP), lambda x: x != "")


def sentence_word_counts(text: Column) -> Column:
    """ASCII words of each sentence that has any."""
    return F.filter(F.transform(sentences(text), lambda s: F.regexp_count(s, F.lit(ASCII_WORD))), lambda n: n > 0)


def sentence_marks(text: Column) -> Column:
    return F.regexp_count(text, F.lit(SENTENCE_MARK))


def paragraphs(text: Column, gap: str = r"\n\s*\n") -> Column:
    return F.filter(F.transform(F.split(F.trim(text), gap), F.trim), lambda p: p != "")


def surface(text: Column) -> Column:
    """Typographic quotes and dashes made plain, punctuation at the edges dropped."""
    plain = F.translate(text, "‘’“”–—", "''\"\"--")
    return F.regexp_replace(plain, r"^[\s\p{Punct}]+|[\s\p{Punct}]+$", "")


def content_tokens(text: Column) -> Column:
    """Distinct ASCII words of three letters or more that are no stopwords."""
    stop = F.array(*map(F.lit, STOPWORDS))
    return F.array_distinct(F.filter(ascii_words(text), lambda w: (F.length(w) > 2) & ~F.array_contains(stop, w)))


def jaccard(left: Column, right: Column) -> Column:
    """Overlap of two sets; null if either is empty."""
    both = F.size(F.array_intersect(left, right)).cast("double")
    return F.when((F.size(left) > 0) & (F.size(right) > 0), both / F.size(F.array_union(left, right)))


def once(value: Column, use) -> Column:
    """``use(value)``, with the value made once, also where it is used inside of a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def occurrences(words: Column, phrase: Column) -> Column:
    """Starts (0-based) at which the phrase's words stand in a row."""

    def starts(both: Column) -> Column:
        w, p = both["w"], both["p"]
        n, k = F.size(w), F.size(p)
        every = F.when((k > 0) & (n >= k), F.sequence(F.lit(0), n - k)).otherwise(F.array().cast("array<int>"))
        # Most starts fail at their first word.
        return F.filter(every, lambda i: (F.get(w, i) == F.get(p, F.lit(0))) & (F.slice(w, i + 1, k) == p))

    return once(F.struct(words.alias("w"), phrase.alias("p")), starts)


def substring_starts(text: Column, part: Column) -> Column:
    """All starts (0-based) of a substring; occurrences may overlap.

    Text and part are compared as arrays of characters: a position in a string would be sought
    from its start each time.
    """
    chars = lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, ""))
    return occurrences(chars(text), chars(part))


def fill_blank(stem: Column, option: Column, blank: str = "____") -> Column:
    """The first blank replaced; later ones stay."""
    at = F.instr(stem, blank)
    filled = F.concat(F.substring(stem, F.lit(1), at - 1), option, F.substring(stem, at + len(blank), F.length(stem)))
    return F.when(at > 0, filled).otherwise(stem)


def safe_name(text: Column) -> Column:
    return F.regexp_replace(text, r"[^A-Za-z0-9._-]+", "_")


def contains_any(text: Column, terms: list[str]) -> Column:
    lowered, hit = F.lower(text), F.lit(False)
    for term in terms:
        hit = hit | lowered.contains(term.lower())
    return hit


def cascade(text: Column, rules: list[tuple[str, list[str]]], default: str) -> Column:
    """The class of the first rule of which a keyword occurs."""
    out = F.lit(default)
    for name, terms in reversed(rules):
        out = F.when(contains_any(text, terms), name).otherwise(out)
    return out


def bins(value: Column, edges: list[tuple[float, str]], last: str) -> Column:
    """The label of the first edge that the value doesn't pass."""
    out = F.lit(last)
    for edge, label in reversed(edges):
        out = F.when(value <= edge, label).otherwise(out)
    return out


LENGTH_BINS = [(10, "<=10"), (15, "11-15"), (20, "16-20"), (25, "21-25"), (30, "26-30")]


def passage_band(words: Column) -> Column:
    return F.when(words < WORDS_LEAST, "BELOW_EMPIRICAL_MINIMUM").when(words > WORDS_MOST, "ABOVE_EMPIRICAL_PREFERRED_BAND").otherwise("EMPIRICAL_PREFERRED_BAND")


def edit_parts(notation: Column) -> Column:
    """before, after and status of an edit written as ``a => b``, change, delete or add."""

    def quoted(verb: str, rest: str = "") -> str:
        return rf"(?i){verb}\s+['\"](.+?)['\"]{rest}"

    arrow = r"^(.*?)(?:→|=>)(.*)$"
    change = quoted("change", r"\s+to\s+['\"](.+?)['\"]")
    none = F.lit(None).cast("string")
    strip = lambda c: F.regexp_replace(c, r"^[ '\"]+|[ '\"]+$", "")

    def row(before, after, status):
        return F.struct(before.alias("before"), after.alias("after"), F.lit(status).alias("status"))

    return (
        F.when(notation.rlike("(?i)no correction|no change|already correct"), row(none, none, "no_correction_claimed"))
        .when(notation.rlike(arrow), row(strip(F.regexp_extract(notation, arrow, 1)), strip(F.regexp_extract(notation, arrow, 2)), "parsed_replacement"))
        .when(notation.rlike(change), row(F.regexp_extract(notation, change, 1), F.regexp_extract(notation, change, 2), "parsed_replacement"))
        .when(notation.rlike(quoted("delete")), row(F.regexp_extract(notation, quoted("delete"), 1), F.lit(""), "parsed_deletion"))
        .when(notation.rlike(quoted("add")), row(F.lit(""), F.regexp_extract(notation, quoted("add"), 1), "parsed_insertion"))
        .otherwise(row(none, none, "not_parseable"))
    )


def edit_size(parts: Column) -> Column:
    """Words of the larger side; 0 if no edit is claimed, null if it can't be read."""
    size = F.greatest(F.size(lexical_tokens(parts["before"])), F.size(lexical_tokens(parts["after"])))
    return F.when(parts["status"] == "no_correction_claimed", 0).when(parts["status"] != "not_parseable", size)
