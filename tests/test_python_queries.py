"""Queries beyond SQL against plain Python."""

import collections
import hashlib
import re
import string
import textwrap
import unicodedata
from difflib import SequenceMatcher

from wordloom.plans import catalogue


def run(name, spark, data):
    return catalogue.queries()[name](spark, data).collect()


def test_near_duplicate_pairs(spark, data):
    names = {r["p_partkey"]: " ".join(r["p_name"].split()).lower() for r in spark.read.parquet(f"{data}/part.parquet").collect()}
    rows = run("near_duplicate_pairs", spark, data)
    assert rows
    for r in rows:
        assert r["ratio"] == SequenceMatcher(None, names[r["p_partkey"]], names[r["other"]]).ratio()
        assert r["near"] == (r["ratio"] >= 0.92)


def test_turn_edits(spark, data):
    texts = {(r["conv_id"], r["turn"]): r["text"].split() for r in spark.read.parquet(f"{data}/conversations.parquet").collect()}
    for r in run("turn_edits", spark, data):
        words = texts[r["conv_id"], r["turn"]]
        assert r["one_move"] == (words[0] != words[1])


def test_wrapped_lines(spark, data):
    texts = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()}
    lines = {}
    for r in sorted(run("wrapped_lines", spark, data), key=lambda r: (r["item_id"], r["number"])):
        lines.setdefault(r["item_id"], []).append(r["line"])
    for item, text in texts.items():
        want = [x for p in text.split("\n") for x in (textwrap.wrap(p, 72, break_long_words=False, break_on_hyphens=False) or [""])]
        assert lines[item] == want


def test_stateful_lifecycle(spark, data):
    steps = run("transition_audit", spark, data)
    want = {}
    for r in sorted(steps, key=lambda r: (r["user_id"], r["step"])):
        _, n, bad = want.get(r["user_id"], ("", 0, 0))
        want[r["user_id"]] = (r["state"], n + 1, bad + (not r["legal"]))
    got = {r["user_id"]: (r["state"], r["steps"], r["illegal"]) for r in run("stateful_lifecycle", spark, data)}
    assert got == want


def test_monotone_alignment(spark, data):
    import json

    from wordloom.plans.geometry_queries import marked

    got = {r["item_id"]: (json.loads(r["spans"]), r["status"]) for r in run("monotone_alignment", spark, data)}
    rows = marked(spark, data).collect()
    assert len(rows) == len(got)
    for r in rows:
        words, spans = r["w"], [r["spans"][i] for i in (1, 0, 2, 3)]
        last, status, want = -1, "aligned", []
        for s in spans:
            phrase = words[s["start"] : s["end"]] if s else []
            at = [i for i in range(len(words) - len(phrase) + 1) if phrase and words[i : i + len(phrase)] == phrase]
            good = [i for i in at if i >= last]
            if not at:
                status = "unmatched_marked_part"
                want.append(None)
                continue
            if not good:
                status = "aligned_with_repeated_or_nonmonotonic_occurrence"
            start = (good or at)[0]
            last = start + len(phrase)
            want.append({"start": start, "end": last})
        assert got[r["item_id"]] == (want, status)


def test_stratified_sample(spark, data):
    rows = [r.asDict() for r in spark.read.parquet(f"{data}/orders.parquet").selectExpr("o_orderkey", "o_orderstatus", "o_orderpriority", "year(o_orderdate) AS year").collect()]
    got = {(r["o_orderstatus"], r["rank"]): r["o_orderkey"] for r in run("stratified_sample", spark, data)}
    for state in {r["o_orderstatus"] for r in rows}:
        pool, picked = [r for r in rows if r["o_orderstatus"] == state], []
        while pool and len(picked) < 12:
            times = lambda field, r: sum(p[field] == r[field] for p in picked)
            best = min(pool, key=lambda r: (times("o_orderpriority", r), times("year", r), r["o_orderkey"]))
            pool.remove(best)
            picked.append(best)
            assert got[state, len(picked)] == best["o_orderkey"]


def test_surface_offsets(spark, data):
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()}
    rows = run("surface_offsets", spark, data)
    assert len(rows) > 10
    for r in rows:
        word = items[r["item_id"]].split(" ")[1]
        source = "  “" + items[r["item_id"]].replace(" ", " \t ").replace("'", "’") + "” \n"
        bare = word.strip(string.punctuation + " ").replace("'", "’")
        # Dashes and apostrophes next to a word join it to others.
        spans = [m.span() for m in re.finditer(rf"(?<![\w'’–—-]){re.escape(bare)}(?![\w'’–—-])", unicodedata.normalize("NFC", source), re.IGNORECASE)]
        assert r["spans"] == ",".join(f"{a}:{b}" for a, b in spans) and r["n"] == len(spans) > 0


def test_surfaces_keep_offsets():
    from wordloom.functions.udfs import surface_with_offsets

    text, places = surface_with_offsets("  “Straße —\t X’s… Ünı” ")
    assert text == "strasse - x's… ünı" and len(places) == len(text)
    assert places[4] == places[5] == (7, 8) and places[8] == (10, 11) and places[9] == (11, 13) and places[10] == (13, 14)
    assert surface_with_offsets("") == ("", []) and surface_with_offsets(" .!") == ("", [])


def test_resolved_targets(spark, data):
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()}
    rows, edge = run("resolved_targets", spark, data), string.punctuation + string.whitespace
    assert {r["status"] for r in rows} & {"declared", "normalized"}
    for r in rows:
        target = items[r["item_id"]].split()[5]
        assert r["target"] == target
        lines = [x for p in items[r["item_id"]].split("\n") for x in (textwrap.wrap(p, 72, break_long_words=False, break_on_hyphens=False) or [""])]
        hits = [n for n, line in enumerate(lines, 1) if re.search(rf"(?<![\w'-]){re.escape(target.strip(edge))}(?![\w'-])", line)]
        assert r["matches"] == ",".join(map(str, hits))
        want = (1, "declared") if 1 in hits else (hits[0], "normalized") if len(hits) == 1 else (None, "ambiguous" if hits else "not_found")
        assert (r["line"], r["status"]) == want


def test_edit_integrity(spark, data):
    texts = {(r["conv_id"], r["turn"]): r["text"].split() for r in spark.read.parquet(f"{data}/conversations.parquet").collect()}
    rows = run("edit_integrity", spark, data)
    assert len({r["errors"] for r in rows}) >= 3
    for r in rows:
        w, kind = texts[r["conv_id"], r["turn"]], r["turn"] % 4
        v = [w, [w[0], "@@", *w[2:]], ["@@", *w[1:-1], "##"], w[:2] + w[3:]][kind]
        edits = [c for c in SequenceMatcher(None, w, v, autojunk=False).get_opcodes() if c[0] != "equal"]
        sizes = [max(j - i, m - k) for _, i, j, k, m in edits]
        want = [e for e, bad in (("no_edit", not edits), ("several_edits", len(edits) > 1), ("edit_not_local", any(s > 1 for s in sizes)), ("edit_outside_span", any(i < 1 or j > 3 for _, i, j, _, _ in edits))) if bad]
        assert r["errors"] == ",".join(want)
        measured = ("none" if not edits else "several" if len(edits) > 1 else edits[0][0], sum(sizes))
        assert (r["kind"], r["size"]) == measured and r["status"] == ("PASS" if measured == ("replace", 1) else "FAIL")


def test_adapted_compositions(spark, data):
    from wordloom.plans.audit_queries import CAPS, KINDS, ONCE, WEIGHTS

    def drawn(total, *parts):
        return int(hashlib.sha256("|".join(map(str, parts)).encode()).hexdigest()[:8], 16) % total

    seen = collections.defaultdict(lambda: [0] * len(KINDS))
    for r in spark.read.parquet(f"{data}/events.parquet").collect():
        seen[r["user_id"]][KINDS.index(r["event_type"])] += 1
    rows = run("adapted_compositions", spark, data)
    assert len(rows) > 50
    for r in rows:
        user = drawn(max(seen) + 1, "row", r["c_custkey"])
        counts, step = [min(n, cap) for n, cap in zip(seen[user], CAPS)], 0
        while sum(counts) != r["total"]:
            step += 1
            more = sum(counts) < r["total"]
            chances = [0 if i == ONCE and counts[i] >= 1 else w for i, w in enumerate(WEIGHTS)] if more else list(counts)
            at = drawn(sum(chances), "adapt", r["c_custkey"], step)
            i = next(i for i in range(len(chances)) if at < sum(chances[: i + 1]))
            counts[i] += 1 if more else -1
        assert r["counts"] == ",".join(map(str, counts))
