"""Display lines of passages, and the line that a question's target stands in.

A passage is shown in lines of WIDTH columns, paragraph by paragraph. A target's declared line
stands if the target is in it. Otherwise the only line that has the target takes its place; of
several, the one in which the target's only occurrence inside the question's evidence lies, if the
evidence (an anchor in a paragraph) occurs there once. Whatever stays open is told as such, and
nothing is chosen by order or nearness.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import udfs
from .contracts import has_expression, stem_reference

WIDTH = 72
_BEFORE_NUMBER = r"(?i)^(the (?:word|phrase|expression) .+? in line )\d+"


def line_starts(body: Column, width: int = WIDTH) -> Column:
    """Offsets at which the display lines of a paragraph with single blanks begin; a word longer than a line has its own."""
    first = F.struct(F.lit(0).alias("at"), F.array(F.lit(0)).alias("starts"))

    def place(held: Column, word: Column) -> Column:
        end, begun = held["at"] + F.length(word), F.element_at(held["starts"], -1)
        fits = (end - begun <= width) | (held["at"] == begun)
        return F.struct((end + 1).alias("at"), F.when(fits, held["starts"]).otherwise(F.array_append(held["starts"], held["at"])).alias("starts"))

    return F.aggregate(F.split(body, " "), first, place, lambda held: held["starts"])


def paragraphs(passages: DataFrame, key: str, text: str = "text", width: int = WIDTH) -> DataFrame:
    """The paragraphs of passages: key, paragraph (from 1), body (NFC, single blanks), starts and lines, before (lines of paragraphs before it)."""
    each = passages.select(key, F.posexplode(udfs.display_paragraphs(F.col(text), F.lit(width))).alias("i", "p"))
    return each.select(key, (F.col("i") + 1).alias("paragraph"), "p.body", "p.starts", "p.lines", "p.before")


def _folded(text: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(text, r"(?U)\s+", " ")))


def _once(text: Column, part: Column) -> Column:
    """Where a part stands in a text (from 0), if it does so once, overlaps counted; else null."""
    at = F.instr(text, part)
    return F.when((part != "") & (at > 0) & (F.call_function("locate", part, text, at + 1) == 0), at - 1)


def anchored_lines(asked: DataFrame, parts: DataFrame, key: str) -> DataFrame:
    """``asked`` (key, target, paragraph, anchor) with ``anchored``: the line of the target's only occurrence inside the only occurrence of the anchor in its paragraph; null without one."""
    own = parts.select(F.col(key).alias("_key"), F.col("paragraph").alias("_paragraph"), "body", "starts", "lines", "before")
    met = asked.join(own, (F.col(key) == F.col("_key")) & (F.col("paragraph") == F.col("_paragraph")), "left")
    body, anchor = F.lower("body"), _folded(udfs.nfc("anchor"))
    # Offsets in the lower-cased paragraph are its own only if lower-casing keeps its length.
    begin = F.when(F.length(body) == F.length("body"), _once(body, anchor))
    met = met.withColumn("_from", begin).withColumn("_to", F.col("_from") + F.length(anchor))
    # Not a filter by a lambda, which would search the paragraph for its anchor again for each span.
    met = met.withColumn("_spans", udfs.expression_spans_between("body", "target", "_from", "_to"))
    span = F.get("_spans", F.lit(0))
    number = F.size(F.filter("starts", lambda s: s <= span["start"]))
    inside = span["end"] <= F.element_at("starts", number) + F.length(F.element_at("lines", number))
    found = F.when(F.size("_spans") == 1, F.when(inside, F.col("before") + number))
    return met.select(*asked.columns, found.alias("anchored"))


def normalized_targets(passages: DataFrame, questions: DataFrame, key: str, text: str = "text", width: int = WIDTH) -> DataFrame:
    """The audit record of each question's target line.

    ``questions`` has key, question, target, declared, paragraph and anchor (the evidence; null
    for none) and stem. Adds line (null if it stays open), resolution, matches (the lines that have
    the target), stem (its line number set right where it names this target and the declared line)
    and rewritten. A question without a target or a passage has no record.
    """
    parts = paragraphs(passages, key, text, width)
    lines = parts.select(F.col(key).alias("_key"), "before", F.posexplode("lines").alias("i", "shown")).select("_key", (F.col("before") + F.col("i") + 1).alias("number"), "shown")
    asked = questions.where(F.trim("target") != "")
    wanted = asked.select(key, "question", _folded(udfs.nfc("target")).alias("_wanted"))  # once a question, not once a line
    met = wanted.join(lines, F.col(key) == F.col("_key"))
    hit = has_expression(F.lower("shown"), F.col("_wanted"))
    hits = met.groupBy(key, "question").agg(F.array_sort(F.collect_list(F.when(hit, F.col("number")))).alias("matches"))
    told = anchored_lines(asked, parts, key).join(hits, [key, "question"])
    n, stands = F.size("matches"), F.coalesce(F.array_contains("matches", F.col("declared")), F.lit(False))
    anchored = F.when(F.array_contains("matches", F.col("anchored")), F.col("anchored"))
    resolution = F.when(stands & (n > 1), "SUPPLIED_LINE_MATCH").when(n == 1, "UNIQUE_SURFACE_MATCH").when(n == 0, "ZERO_SURFACE_MATCH").when(anchored.isNotNull(), "EVIDENCE_ANCHOR_SURFACE_MATCH").otherwise("MULTIPLE_SURFACE_MATCH")
    line = F.when(stands, F.col("declared")).when(n == 1, F.get("matches", F.lit(0))).otherwise(anchored)
    told = told.withColumn("resolution", resolution).withColumn("line", line)
    named = stem_reference(F.col("stem"))
    same = _folded(tx.surface(named["target"])) == _folded(tx.surface(udfs.nfc("target")))
    moved = F.coalesce((named["kind"] == "line") & same & (named["number"] == F.col("declared")) & (F.col("declared") >= 1) & (F.col("line") != F.col("declared")), F.lit(False))
    stem = F.when(moved, F.concat(F.regexp_extract("stem", _BEFORE_NUMBER, 1), F.col("line").cast("string"), F.regexp_replace("stem", _BEFORE_NUMBER, ""))).otherwise(F.col("stem"))
    return told.select(key, "question", "target", "declared", "line", "resolution", "matches", stem.alias("stem"), moved.alias("rewritten"))
