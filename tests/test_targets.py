"""Target lines against Python's text wrapping and plain searches."""

import re
import string
import textwrap
import unicodedata

from wordloom.functions.udfs import nfc_pieces, surface_with_offsets
from wordloom.operators import targets
from wordloom.plans import catalogue

QUESTIONS = "k long, question int, target string, declared int, paragraph int, anchor string, stem string"


def shown(text):
    out = []
    for p in re.split(r"\n\s*\n", unicodedata.normalize("NFC", text).replace("\r\n", "\n").replace("\r", "\n").strip()):
        p = re.sub(r"\s+", " ", p).strip()
        if p:
            out.append((p, textwrap.wrap(p, 72, break_long_words=False, break_on_hyphens=False)))
    return out


PASSAGE = (
    "The watershed gathers rain. Every watershed has a divide, and each divide parts one watershed from the next one along a crest.\r\n\r\n"
    "A  second paragraph\tnames the delta — once — and “the crest” again, " + "w" * 90 + " then goes on with words until it wraps to several lines, the last of which has a delta’s name.\n \n\n"
    "Café and café stand here; a crest is here too."
)


def test_lines_like_textwrap(spark):
    texts = [(1, PASSAGE), (2, ""), (3, " \n\n "), (4, "word"), (5, "x" * 200 + " y"), (6, " ".join(["ab"] * 400)), (7, None), (8, "a" * 72 + " " + "b" * 71 + " c d")]
    got = {}
    for r in sorted(targets.paragraphs(spark.createDataFrame(texts, "k long, text string"), "k").collect(), key=lambda r: (r.k, r.paragraph)):
        assert r.before == sum(len(x) for _, x in got.get(r.k, []))
        got.setdefault(r.k, []).append((r.body, list(r.lines)))
        assert [r.body[s : s + len(line)] for s, line in zip(r.starts, r.lines)] == list(r.lines)
    assert got == {k: shown(t) for k, t in texts if t and shown(t)}


def test_every_resolution(spark):
    lines = [x for _, own in shown(PASSAGE) for x in own]
    at = lambda part: next(n for n, x in enumerate(lines, 1) if part in x)
    last = len(lines)
    asked = {
        1: (("watershed", at("watershed"), None, None, "stem"), ("SUPPLIED_LINE_MATCH", at("watershed"))),
        2: (("GATHERS", 99, None, None, "s"), ("UNIQUE_SURFACE_MATCH", at("gathers"))),
        3: (("ocean", 1, 1, "rain", "s"), ("ZERO_SURFACE_MATCH", None)),
        4: (("crest", 99, 2, "“the crest” again", "s"), ("EVIDENCE_ANCHOR_SURFACE_MATCH", at("the crest” again"))),
        5: (("crest", 99, 2, "the second paragraph names", "s"), ("MULTIPLE_SURFACE_MATCH", None)),  # an anchor that isn't there
        6: (("crest", 99, 9, "the crest", "s"), ("MULTIPLE_SURFACE_MATCH", None)),  # no such paragraph
        7: (("crest", 99, None, None, "s"), ("MULTIPLE_SURFACE_MATCH", None)),
        8: (("watershed", 99, 1, "watershed", "s"), ("MULTIPLE_SURFACE_MATCH", None)),  # the anchor stands more than once
        9: (("watershed", 99, 1, "Every watershed has a divide, and each divide parts one watershed", "s"), ("MULTIPLE_SURFACE_MATCH", None)),  # the target does so in it
        10: (("watershed", 99, 1, "has a  DIVIDE, and each divide parts one Watershed", "The word 'watershed' in line 99 means"), ("EVIDENCE_ANCHOR_SURFACE_MATCH", at("parts one") if "watershed" in lines[at("parts one") - 1].split("parts one")[1] else at("parts one") + 1)),
        11: (("crest", 99, 2, "delta", "s"), ("MULTIPLE_SURFACE_MATCH", None)),  # an anchor without the target
        12: (("café", None, 3, "café stand", "s"), ("UNIQUE_SURFACE_MATCH", last)),
        13: (("cres", 1, None, None, "s"), ("ZERO_SURFACE_MATCH", None)),  # no part of a word
        14: (("gathers", 5, None, None, "The word 'rain' in line 5 means"), ("UNIQUE_SURFACE_MATCH", 1)),
    }
    rows = [(1, q, *given) for q, (given, _) in asked.items()] + [(1, 20, " ", 1, 1, "x", "s"), (1, 21, None, 1, 1, "x", "s"), (2, 1, "a", 1, 1, "a", "s")]
    passages = spark.createDataFrame([(1, PASSAGE), (3, "other")], "k long, text string")
    got = {r.question: r for r in targets.normalized_targets(passages, spark.createDataFrame(rows, QUESTIONS), "k").collect()}
    assert {q: (r.resolution, r.line) for q, r in got.items()} == {q: want for q, (_, want) in asked.items()}
    assert got[10].rewritten and got[10].stem == f"The word 'watershed' in line {got[10].line} means"
    assert not got[14].rewritten and got[14].stem.endswith("line 5 means") and not got[1].rewritten


def test_anchored_targets(spark, data):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    rows, edge = catalogue.queries()["anchored_targets"](spark, data).collect(), string.punctuation + string.whitespace
    assert len({r.resolution for r in rows}) >= 4 and any(r.rewritten for r in rows)
    for r in rows:
        text = docs[r.doc_id].text
        words = text.split()
        m = len(words) // 2
        parts = shown(text)
        lines = [x for _, own in parts for x in own]
        find = lambda x, where: [s.span() for s in re.finditer(rf"(?<![\w'-]){re.escape(x)}(?![\w'-])", where)]
        bare = lambda x: x.translate(str.maketrans("‘’“”–—", "''\"\"--")).strip(edge).lower()
        target = bare(words[m])
        hits = [n for n, line in enumerate(lines, 1) if target and find(target, bare(line))]
        assert r.matches == ",".join(map(str, hits)) and r.target == words[m]
        anchor = {"en": " ".join(words[m - 1 : m + 2]), "de": words[m], "fr": " ".join(words[:3])}.get(docs[r.doc_id].lang)
        want = None
        if 1 in hits:
            want = 1
        elif len(hits) == 1:
            want = hits[0]
        elif hits and anchor:
            body, own = parts[0]
            starts = [i for i in range(len(body)) if body.lower().startswith(anchor.lower(), i)]
            if len(starts) == 1:
                plain = body.translate(str.maketrans("‘’“”–—", "''\"\"--")).lower()
                inside = [s for s in find(target, plain) if starts[0] <= s[0] and s[1] <= starts[0] + len(anchor)]
                at, line = 0, 0
                for n, x in enumerate(own, 1):
                    at = body.index(x, at)
                    if len(inside) == 1 and at <= inside[0][0] and inside[0][1] <= at + len(x):
                        line = n
                    at += len(x)
                want = line if line in hits else None
        assert r.line == want, (r, want)


def test_offsets_are_those_of_the_text_as_given():
    for text in ("é abc café word", "한 word", "Ạ̊ x̣́ word", "word"):
        surface, places = surface_with_offsets(text)
        start = surface.index("word")
        assert text[places[start][0] : places[start + 3][1]] == "word"
        assert "".join(x for x, _, _ in nfc_pieces(text)) == unicodedata.normalize("NFC", text)
        assert "".join(text[a:b] for _, a, b in nfc_pieces(text)) == text


def test_spans_between_offsets(spark):
    from pyspark.sql import functions as F

    from wordloom.functions import udfs

    rows = spark.createDataFrame([("a b a b", "a", 1, 7), ("a b a b", "a", None, None)], "t string, w string, f int, s int")
    got = [r.x for r in rows.select("f", udfs.expression_spans_between("t", "w", "f", "s").alias("x")).orderBy(F.col("f").desc_nulls_last()).collect()]
    assert [tuple(s) for s in got[0]] == [(4, 5)] and got[1] is None
