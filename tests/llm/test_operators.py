"""The corpus operators on small inputs: edge cases and brute force."""

import collections
import hashlib
import random
import re
import string
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordloom.llm import bpe, buckets, components, decontaminate, packing, pii, quality, sharding, simhash, substring_dedup, token_store, url_filter, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp long, row long, pii string, class string, unit int, _doc int, _own_fp int"
PROSE = "the quick brown fox jumps over a lazy dog while seven wizards quietly box near old mill pond and then go home by night "


def words(n, seed=0):
    r = random.Random(seed)
    return " ".join("".join(r.choices(string.ascii_lowercase, k=r.randint(2, 8))) for _ in range(n))


def docs_of(spark, rows):
    return spark.createDataFrame([(d, t, "en", "s", len(t or ""), 1, 2, "p", "c", 3, 4, 5) for d, t in rows], DOCS).repartition(3)


EDGE = [(1, None), (2, ""), (3, " \n\t"), (4, words(60, 1)), (4, words(60, 1)), (5, words(60, 1)), (None, words(70, 2)), (None, None), (6, "Ünï " * 30), (7, words(40000, 3)), (8, "x" * 50000), (9, "!!")]


@pytest.fixture(scope="module")
def edge(spark):
    return docs_of(spark, EDGE).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


# 1 URL filter


def test_url_filter(spark):
    urls = ["http://a.net/", "http://a.net", "https://X.EXAMPLE.net/en/1?q", "http://example.com/de/", "http://w.org/fr/porn", None, "nothing", "", "http://b.org/xxx/", "http://b.org/xxxy/", "http://b.org/casino", "http://b.org/casino-POKER", "http://b.org/casino.casino", "http://anet/", "http://q.org/a\nb/xxx", "ftp://h:80/p#f"]
    pages = spark.createDataFrame([(i, u, 0) for i, u in enumerate(urls)], "page_id long, url string, host int")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.url_filter(pages).collect()}
    assert got[0] == ("a.net", "/", "net/", "block")
    assert got[1] == ("a.net", "", None, "allow")
    assert got[2] == ("x.example.net", "/en/1", "example.net/en/", "allow")
    assert got[3] == ("example.com", "/de/", "example.com/de/", "block")
    assert got[4] == ("w.org", "/fr/porn", "org/fr/", "allow")
    assert got[5] == got[6] == got[7] == ("", "", None, "allow")
    assert [got[i][3] for i in (8, 9, 10, 11, 12, 13, 14)] == ["block", "allow", "allow", "block", "allow", "allow", "block"]
    assert got[15][:2] == ("h:80", "/p")
    assert url_filter.url_filter(pages.limit(0)).count() == 0


def test_url_vocabulary_of_a_table(spark):
    terms = spark.createDataFrame([("Bad", None), ("bad", 1), ("so", 1), ("so", 2), ("mild", 1), ("", None), (None, 3), ("a-b", 2)], "term string, weight int")
    own = url_filter.Vocabulary.of_table(terms, soft_weight=3)
    assert own.strict == ("bad",) and own.soft == {"so": 2, "mild": 1, "a-b": 2}
    urls = ["http://h.org/BAD", "http://h.org/badly", "http://h.org/so", "http://h.org/so/so/so", "http://h.org/so-mild", "http://h.org/a-b/mild", "http://h.org/a-b.so", "http://h.org/a-bc/so"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r["page_id"]: r["verdict"] for r in url_filter.url_filter(pages, rules=(), vocabulary=own).collect()}
    assert [got[i] for i in range(8)] == ["block", "allow", "allow", "allow", "block", "block", "block", "allow"]


# 2 Substring dedup


def clusters_by_force(rows):
    parts = []
    for d, t in rows:
        for i, line in enumerate((t or "").split("\n")):
            w = line.encode().lower().split()
            if len(w) >= substring_dedup.MIN_WORDS:
                parts.append((d, i, {tuple(w[k : k + 5]) for k in range(len(w) - 4)}))
    root = list(range(len(parts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(parts)):
        for b in range(a):
            x, y = parts[a][2], parts[b][2]
            if len(x & y) >= 0.8 * len(x | y):
                root[max(find(a), find(b))] = min(find(a), find(b))
    groups = collections.defaultdict(list)
    for n in range(len(parts)):
        groups[find(n)].append(n)
    return {(parts[n][0], parts[n][1]): parts[g][0] for g, m in groups.items() if len(m) > 1 for n in m}


def test_paragraphs_like_brute_force(spark, monkeypatch):
    r = random.Random(5)
    base, rows = words(120, 9).split(), []
    for d in range(60):  # a chain of near copies, each one word from the last
        if d % 2:
            base[r.randrange(len(base))] = f"w{d}"
        rows.append((d, words(30, 100 + d) + "\n" + " ".join(base) + "\nshort line"))
    rows += [(60 + d, words(25, 7)) for d in range(5)]
    want = clusters_by_force(rows)
    monkeypatch.setattr(substring_dedup, "BUCKET_ROWS", 8)  # many chunks of one bucket
    got = {(x["doc_id"], x["paragraph"]): x["cluster_id"] for x in substring_dedup.repeated_paragraphs(docs_of(spark, rows)).where("kind = 'line'").collect()}
    assert got == want and len(got) > 60


def test_short_paragraphs_like_brute_force(spark):
    r, rows, want = random.Random(6), [], collections.defaultdict(set)
    short, near = [words(n, 700 + n) for n in range(1, 20)], words(19, 750).split()
    for d in range(40):
        lines = [words(r.randrange(1, 20), 800 + d), *r.sample(short, 3), " ".join([*near[:18], f"end{d}"]).upper()]
        rows.append((d, "\n".join(lines)))
        for i in (1, 2, 3):
            want[lines[i]].add((d, i))
        want["near"].add((d, 4))  # 14 of 16 shingles
    want = {x: min(m)[0] for m in want.values() if len(m) > 1 for x in m}
    got = {(x["doc_id"], x["paragraph"]): x["cluster_id"] for x in substring_dedup.repeated_paragraphs(docs_of(spark, rows)).where("kind = 'line'").collect()}
    assert got == want and len(got) > 150


def test_paragraph_edges(edge, empty):
    both = substring_dedup.repeated_paragraphs(edge).collect()
    rows = [r for r in both if r["kind"] == "line"]
    assert {r["doc_id"] for r in both} == {4, 5}
    assert {r["doc_id"] for r in rows} == {4, 5} and sum(r["removed"] for r in rows) == 1
    assert substring_dedup.repeated_paragraphs(empty).count() == 0
    kept = {r["doc_id"]: r for r in substring_dedup.remove_repeats(edge).where("doc_id IN (4, 5)").collect()}
    assert kept[5]["text"] == "" and kept[5]["n_chars"] == 0 and kept[4]["text"] == words(60, 1)


def test_passages_like_brute_force(spark):
    r, shared, rows = random.Random(8), [words(n, 900 + n) for n in (50, 54, 75)], []
    for d in range(40):
        parts = [words(r.randrange(5, 120), 2000 + d)]
        for _ in range(r.randrange(3)):
            passage = r.choice(shared).split(" ")
            passage[r.randrange(1, 49)] += "\n"  # a line may break inside a passage
            parts += [" ".join(passage).upper(), words(r.randrange(5, 60), 3000 + r.randrange(10**6))]
        rows.append((d, " ".join(parts)))
    rows += [(50, "a " * 300), (51, "a " * 300 + "b"), (None, words(80, 4)), (60, None), (61, "")]
    runs, where = {d: (t or "").lower().split() for d, t in rows}, collections.defaultdict(set)
    for size in (20, 50):
        for d, w in runs.items():
            for k in range(len(w) - size + 1):
                where[tuple(w[k : k + size])].add(d)
    got = collections.defaultdict(list)
    for x in substring_dedup.repeated_passages(docs_of(spark, rows)).collect():
        got[x["doc_id"]].append(range(x["first_word"], x["first_word"] + x["n_words"]))
    assert {50, 51} <= set(got) and None not in got
    found = 0
    for d, w in runs.items():
        for k in range(len(w) - 49):
            if len(where[tuple(w[k : k + 50])]) > 1:  # some window of each stretch is reported
                assert any(set(p) & set(range(k, k + 50)) for p in got[d])
                found += 1
        for p in got[d]:
            assert len(where[tuple(w[p.start : p.start + 20])]) > 1 and len(where[tuple(w[p.stop - 20 : p.stop])]) > 1
    assert found > 30
    texts = {x["doc_id"]: x["text"] for x in substring_dedup.remove_repeats(docs_of(spark, rows)).collect()}
    assert texts[None] == rows[42][1] and texts[60] is None and texts[50] == rows[40][1]
    assert all(set(texts[d].split()) <= set(t.split()) for d, t in rows if t) and sum(len(texts[d]) < len(t) for d, t in rows if t) > 5


def test_passages_are_reported_whole(spark):
    r, rows, want = random.Random(9), [], {}
    for n in (50, 51, 60, 75, 80, 120, 200, 333):
        passage = words(n, 4000 + n)
        for k in range(3):
            before = r.randrange(5, 90)
            want[len(rows)] = (before, n, len(rows) - k, 3, k > 0)
            rows.append((len(rows), " ".join([words(before, 8000 + 10 * n + k), passage, words(r.randrange(5, 90), 9000 + 10 * n + k)])))
    got = substring_dedup.repeated_passages(docs_of(spark, rows)).collect()
    assert {x["doc_id"]: (x["first_word"], x["n_words"], x["cluster_id"], x["cluster_size"], x["removed"]) for x in got} == want and len(got) == len(want)
    left = {x["doc_id"]: x["text"].split() for x in substring_dedup.remove_repeats(docs_of(spark, rows)).collect()}
    for d, (before, n, _, _, removed) in want.items():
        own = rows[d][1].split()
        assert left[d] == (own[:before] + own[before + n :] if removed else own)


@pytest.mark.parametrize("ids", [(1, 2, 3), (None, None, 3), (5, 5, 6), (None, None, None), (5, 5, None), (7, 7, 7)])
def test_passages_of_rows_that_share_a_doc_id_or_have_none(spark, ids):
    passage = words(80, 77)
    rows = [(d, f"{words(9 + 5 * n, 300 + n)} {passage} {words(20, 400 + n)}") for n, d in enumerate(ids)] + [(90, words(200, 5)), (ids[0], None)]
    got = substring_dedup.repeated_passages(docs_of(spark, rows)).collect()
    assert [x["n_words"] for x in got] == [80] * 3 and sum(x["removed"] for x in got) == 2
    assert sorted((x["doc_id"] for x in got), key=str) == sorted(ids, key=str) and sorted(x["first_word"] for x in got) == [9, 14, 19]
    first = next(x for x in got if not x["removed"])
    known = [d for d in ids if d is not None]
    assert first["doc_id"] == min(known, default=None) and {x["cluster_id"] for x in got} == {first["doc_id"]}
    left = [len((x["text"] or "").split()) for x in substring_dedup.remove_repeats(docs_of(spark, rows)).collect()]
    assert sum(left) == 9 + 14 + 19 + 60 + 80 + 200


def test_passages_that_overlap_are_reported_whole(spark):
    """Runs that nest, overlap and repeat in several documents: every word of a run of 50 is reported, and nothing that doesn't repeat."""
    r = random.Random(12)
    pool = [words(n, 100 + n).split() for n in (400, 300, 250)]
    rows = []
    for d in range(70):
        parts = [words(r.randrange(3, 60), 50_000 + d).split()]
        for _ in range(r.randrange(4)):
            source = r.choice(pool)
            at, n = r.randrange(len(source) - 60), r.choice((20, 45, 50, 51, 70, 130, 400))
            piece = source[at : at + n]
            if r.random() < 0.5 and len(piece) > 10:
                piece[r.randrange(len(piece))] = f"edit{d}"
            parts += [piece, words(r.randrange(1, 40), 60_000 + r.randrange(10**6)).split()]
        rows.append((d, " ".join(w for p in parts for w in p)))
    rows += [(200, rows[5][1]), (201, rows[5][1].upper()), (202, rows[9][1] + " " + rows[11][1])]
    runs = {d: t.lower().split() for d, t in rows}
    where = {size: collections.defaultdict(set) for size in (20, 50)}
    for size, held in where.items():
        for d, w in runs.items():
            for k in range(len(w) - size + 1):
                held[tuple(w[k : k + size])].add(d)
    got, kept = collections.defaultdict(set), collections.defaultdict(set)
    for x in substring_dedup.repeated_passages(docs_of(spark, rows)).collect():
        span = range(x["first_word"], x["first_word"] + x["n_words"])
        got[x["doc_id"]] |= set(span)
        if x["removed"]:
            kept[x["doc_id"]] |= set(span)
        w = runs[x["doc_id"]]
        for k in range(span.start, span.stop - 19):
            others = where[20][tuple(w[k : k + 20])]
            assert len(others) > 1 and (not x["removed"] or min(others) < x["doc_id"])
    for d, w in runs.items():
        for k in range(len(w) - 49):
            others = where[50][tuple(w[k : k + 50])]
            if len(others) > 1:
                assert set(range(k, k + 50)) <= got[d], (d, k)
            if min(others) < d:  # all of it is in a document before
                assert set(range(k, k + 50)) <= kept[d], (d, k)


def test_windows_depend_on_their_words_only():
    import numpy as np

    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 1 << 60, size=(2, 300)).astype(np.uint64)
    for n in range(substring_dedup.REACH, 90, 3):
        b[100 : 100 + n] = a[37 : 37 + n]
        one, two = (set(substring_dedup.chosen_windows(np.concatenate([b[:at], x]), np.array([at, 300]))[1].tolist()) for x, at in ((a, 7), (b, 60)))
        assert one & two


def test_bands_reach_recall():
    bands, rows = substring_dedup.tune_bands(0.8, 0.99)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.99


# 3 Packing


def pieces_hold(rows, ids_of, limit=2048):
    by_doc, by_seq = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    for doc_id, ids in ids_of.items():
        at = 0
        for r in sorted(by_doc[doc_id], key=lambda r: r["start"]):
            part = ids[at : at + r["length"]]
            assert r["start"] == at and r["length"] == len(part) > 0 and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
            at += len(part)
        assert at == len(ids)
    padding = 0
    for inside in by_seq.values():
        at = 0
        for r in sorted(inside, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= limit
        padding += 0 if at & (at - 1) == 0 else limit - at
    return padding


def ids(text):
    raw = bpe.encoder().whole(text or "")
    return list(struct.unpack(f"<{len(raw) // 4}I", raw))


def test_packing_documents(spark, empty):
    rows = [(d, t) for d, t in EDGE if d not in (4, None)] + [(100 + i, words(3 * i, i)) for i in range(200)]
    got = packing.pack_documents(docs_of(spark, rows)).collect()
    assert pieces_hold(got, {d: ids(t) + [1] for d, t in rows}) == 0
    assert packing.pack_documents(empty).count() == 0


def test_packing_limits(edge):
    limits = packing.Limits(tokens=64, segments=3, loss=40)
    rows = packing.pack_documents(edge.where("doc_id <> 7"), limits, with_ids=True).collect()
    used = collections.defaultdict(lambda: [0, 0, 0])
    for r in rows:
        u = used[r["sequence_id"]]
        u[0] += r["length"]
        u[1] += 1
        u[2] += r["loss_tokens"]
        assert len(r["ids"]) == r["length"]
    assert all(u[0] <= 64 and u[1] <= 3 and u[2] <= 40 for u in used.values())


def test_packing_conversations(spark):
    turns = [(c, t, "assistant" if t % 2 else "user", words(5 + 7 * t + c, c * 10 + t)) for c in range(40) for t in range(4)] + [(None, 0, None, None), (50, None, "assistant", "")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    limits = packing.Limits(tokens=512, segments=4, loss=300)
    rows = packing.pack_conversations(df, limits).collect()
    assert {r["doc_id"] for r in rows} == {c for c, *_ in turns}
    assert sum(r["length"] for r in rows) == sum(len(ids(t[3])) + 1 for t in turns)
    assert sum(r["loss_tokens"] for r in rows) == sum(len(ids(t[3])) + 1 for t in turns if t[2] == "assistant")
    used = collections.defaultdict(lambda: [0, 0, 0])
    for r in rows:
        u = used[r["sequence_id"]]
        u[0] += r["length"]
        u[1] += 1
        u[2] += r["loss_tokens"]
    assert all(u[0] <= 512 and u[1] <= 4 and u[2] <= 300 for u in used.values())


# 4 WARC


def test_warc_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_ENTRIES", 4)
    pages = [(i, f"http://h{i % 3}.example.org/p{i % 5}?q={i % 2}", ["same", "", None, f"own {i}", "é" * i][i % 5]) for i in range(60)]
    pages += [(60, None, "x"), (61, "no host", "y"), (62, "http://[bad/", "z"), (63, "http://a/\r\nInjected: 1", "w"), (None, "http://n/", "same"), (3, pages[3][1], pages[3][2])]
    df = spark.createDataFrame([(*p, 9) for p in pages], "page_id long, url string, html string, digest int")
    got = sorted(warc.archive_and_read(spark, df).collect(), key=str)
    largest = {}
    for i, _, h in pages:
        if i is not None:
            largest[h or ""] = max(i, largest.get(h or "", -1))
    want = []
    for i, _, h in pages:
        raw = (h or "").encode()
        digest = warc.base64.b32encode(hashlib.sha1(raw).digest()).decode()
        first = largest[h or ""] == i
        want.append((i, len(raw), digest, "response" if first else "revisit", None if first else largest[h or ""]))
    assert [tuple(r) for r in got] == sorted(want, key=lambda x: str(T.Row(page_id=0, payload_bytes=0, payload_digest="", record_type="", refers_to=0).__class__(page_id=x[0], payload_bytes=x[1], payload_digest=x[2], record_type=x[3], refers_to=x[4])))
    assert warc.archive_and_read(spark, df.limit(0)).count() == 0


def test_warc_index_finds_only_what_is_there(spark):
    pages = spark.createDataFrame([(i, f"http://x{i}.org/", "h") for i in range(50)], "page_id long, url string, html string")
    folder = warc.new_dir(spark, "warc-test")
    shards = warc.build_index(warc.write_archives(pages, folder), folder, block_entries=3)
    asked = spark.createDataFrame([("http://x7.org/",), ("http://nowhere.org/",), ("http://x7.org/",)], "url string")
    assert [r["page_id"] for r in warc.lookup(shards, asked).collect()] == [7]


def test_warc_urls_with_other_line_ends(spark):
    marks = ["\x85", "\u2028", "\u2029", "\t", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\r", "\n", "\xa0", " "]
    pages = [(i, url, f"own {i}") for i, url in enumerate(f"http://a.org/{at}" for m in marks for at in (f"x{m}y", f"p?q={m}z", f"{m}", f"x{m}"))]
    pages += [(len(pages) + i, f"{m}no{m}host", f"none {i}") for i, m in enumerate(marks)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    assert sorted(r["page_id"] for r in warc.archive_and_read(spark, df).collect()) == [p[0] for p in pages]


@pytest.mark.parametrize("n", [1, 2, 4, 1000])
def test_warc_gives_back_every_page(spark, n):
    r = random.Random(n)
    odd = [chr(c) for c in (9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 37, 0x85, 0xA0, 0x2028, 0x2029, 0xFEFF, 0x1F600)] + ["a", "Z", "/", "?", "#", ":", "é"]
    pages = [(i, None if i % 97 == 96 else "".join(r.choice(["http://", "", "x://"]) + r.choice(odd) * r.randrange(3) + "h.com/" + "".join(r.choices(odd, k=4)))[:60], f"{i % 7}") for i in range(n)]
    got = warc.archive_and_read(spark, spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert sorted(x["page_id"] for x in got) == list(range(n))


# 5 PII

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum(sum(divmod(int(c) * 2, 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else True, "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


def test_pii_like_brute_force(spark):
    r = random.Random(3)
    texts = [None, "", "a@b.c", "a@b", "a@b.c%x@y.z.", "@@a@b.cc@d.ee@f", "1.2.3.4.5.6.7.8", "300.1.1.1 001.002.003.255", "4111 1111-1111 1111 1 x", "4111111111111111", "+1 (202) 555-0143.", "+12345678", "é 4111111111111111 ü a@b.de", "9" * 3000, "a" * 30000 + "@", "+" + "(" * 2000, "\U0001f600 1.1.1.1"]
    texts += ["".join(r.choices("0123456789.-+() @abZ%", k=r.randint(0, 60))) for _ in range(1500)]
    rows = pii.report(docs_of(spark, list(enumerate(texts)))).collect()
    assert len(rows) == len(texts)
    for row in rows:
        want = base_spans(texts[row["doc_id"]] or "")
        assert [row[f"n_{k}"] for k in pii.BASE] == [sum(s[0] == k for s in want) for k in pii.BASE], texts[row["doc_id"]]
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        assert row["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest(), texts[row["doc_id"]]
        assert row["spans"].startswith(joined)


def test_pii_time_grows_with_the_text(spark):
    import time

    took = {}
    for n in (100, 2000, 20_000):
        docs = spark.createDataFrame([(1, "é ab@cd.org 10.0.0.1 x\n" * n)], "doc_id long, text string")
        began = time.monotonic()
        row = pii.report(docs).collect()[0]
        took[n] = time.monotonic() - began
        assert row["n_email"] == row["n_ip"] == n and row["spans"].endswith(f"ip:{23 * n - 11}:{23 * n - 3}")
        if n < 20_000:
            assert pii.redact(docs).collect()[0]["text"] == "é <EMAIL> <IP> x\n" * n
    assert took[20_000] < 10 * took[2000] + 20


def test_pii_parts_of_long_texts(spark):
    r = random.Random(3)
    text = "".join(r.choice("aé€𝄞\n ") for _ in range(5000))
    spans = [(a, min(a + r.choice((0, 1, 40, 1024, 3000)), 5000)) for a in (0, 1, 1023, 1024, 1025, 2047, 2048, 4096, 4999)]
    rows = spark.createDataFrame([(text, a, b) for a, b in spans], "text string, a int, b int").withColumn("blocks", pii.blocks(F.col("text")))
    got = rows.select("a", "b", pii.part_of(F.col("blocks"), F.col("a"), F.col("b")).alias("part")).collect()
    assert all(x["part"] == text[x["a"] : x["b"]] for x in got)


def test_pii_extra_kinds_and_redaction(spark):
    rows = [(1, "my iban DE89370400440532013000 ok"), (2, "code DE89370400440532013001"), (3, "ssn 123-45-6789"), (4, "number 123-45-6789"), (5, "mail a@b.org or 10.0.0.1!"), (6, None), (7, "plain")]
    docs = docs_of(spark, rows)
    spans = {r["doc_id"]: r["spans"] for r in pii.report(docs).collect()}
    assert spans == {1: "iban:8:30", 2: "", 3: "ssn:4:15", 4: "", 5: "email:5:12,ip:16:24", 6: "", 7: ""}
    out = {r["doc_id"]: (r["text"], r["n_chars"], r["pii"]) for r in pii.redact(docs).collect()}
    assert out[5] == ("mail <EMAIL> or <IP>!", 21, "p") and out[6] == (None, 0, "p") and out[7] == ("plain", 5, "p")


def test_context_decides_as_whole_words(spark):
    texts = {
        1: ("Born 1984-02-29 in a town", "birth:5:15", "50"),
        2: ("stubborn 1984-02-29", "", ""),
        3: ("dob: 1984-13-01, 1984-12-31", "birth:17:27", "50"),
        4: ("released 2001-05-06", "", ""),
        5: ("née en 1999-01-01", "birth:7:17", "50"),
        6: ("passport C01234567", "passport:9:18", "50"),
        7: ("passports C01234567 c01234567", "", ""),
        8: ("Reisepass: C01234567X", "", ""),
        9: ("ssn 000-12-3456 666-12-3456 912-12-3456 123-00-3456 123-12-0000 123-12-3456 ssn", "ssn:64:75", "50"),
        10: ("dossn 123-12-3456", "", ""),
        11: ("hotel 10.0.0.1 ship", "ip:6:14", "60"),
        12: ("the ip 10.0.0.1", "ip:7:15", "80"),
        13: ("born" + " " * 60 + "1984-02-28", "", ""),
    }
    got = {r["doc_id"]: (r["spans"], r["scores"]) for r in pii.report(docs_of(spark, [(d, t) for d, (t, _, _) in texts.items()])).collect()}
    assert got == {d: (spans, scores) for d, (_, spans, scores) in texts.items()}


# 6 Decontamination


def contaminated_by_force(docs, items, window=10):
    cut_up = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    wins = {}
    for i, t in items:
        w = cut_up(t)
        for k in range(max(len(w) - window + 1, 1) if w else 0):
            wins.setdefault(tuple(w[k : k + window]), set()).add(str(i))
    out = []
    for d, t in docs:
        w, hit, met = cut_up(t), set(), set()
        for n in {len(x) for x in wins}:
            for k in range(len(w) - n + 1):
                if (found := wins.get(tuple(w[k : k + n]))) is not None:
                    hit |= set(range(k, k + n))
                    met |= found
        out.append((d, len(w), len(hit), len(met), hashlib.sha256(",".join(sorted(met)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [200_000, 7])
def test_decontamination_like_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", block)
    items = [(1, words(30, 1)), (2, words(12, 2)), (3, "Two Words"), (4, "solo"), (5, None), (6, "  "), (7, words(30, 1)), (8, "É ß 12 " * 4)]
    rows = [*EDGE, (20, words(5, 8) + " " + words(30, 1).upper() + "! end"), (21, " ".join(words(12, 2).split()[1:11])), (22, " ".join(words(12, 2).split()[:9])), (23, "two, words; solo two"), (24, "É ß 12 É ß 12 É ß 12 É"), (25, "é ß 12 é ß 12 é ß 12 é")]
    bench = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, h int")
    got = decontaminate.report(docs_of(spark, rows), bench).collect()
    assert sorted([tuple(r) for r in got], key=str) == contaminated_by_force(rows, items)
    kept = decontaminate.drop_contaminated(docs_of(spark, rows), bench)
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted((x[0] for x in contaminated_by_force(rows, items) if not x[5]), key=str)


def test_decontamination_of_shuffled_rows(spark, monkeypatch):
    items = [(1, words(30, 1)), (2, "two words"), (3, "solo"), (4, "these three words")]
    rows = [(d, " ".join([words(d % 7, 50 + d), "two words" if d % 3 else "solo", words(9, 70 + d), words(30, 1) if d % 4 == 0 else "these three words"])) for d in range(60)] + [(None, "solo"), (None, "solo"), (5, None)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = contaminated_by_force(rows, items)
    for limit in (200_000, 1):
        monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", limit)
        mixed = docs_of(spark, rows).repartition(5, F.rand()).sort(F.rand())  # its rows come in another order each time
        assert sorted([tuple(r) for r in decontaminate.report(mixed, bench).collect()], key=str) == want


def test_decontamination_empty(spark, edge, empty):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert not decontaminate.report(edge, bench).where("contaminated").count()
    assert decontaminate.report(edge, bench).count() == len(EDGE)
    assert decontaminate.report(empty, bench).count() == 0


# 7 Token ids


def test_simple8b_round_trip():
    r = np.random.default_rng(1)
    for n in (0, 1, 2, 59, 60, 61, 1000, 20000):
        for top in (1, 2, 50, 1 << 12, 50257, 1 << 31, 1 << 59, (1 << 64) - 1):
            a = r.integers(0, top, size=n, dtype=np.uint64, endpoint=True)
            a[r.random(n) < 0.3] = 0
            assert (token_store.decode_block(token_store.encode_block(a), n) == a).all()


def test_encoder_equals_the_library():
    e = bpe.WordEncoder(bpe.vocabulary_path(None), 50)
    r = random.Random(2)
    texts = [t for _, t in EDGE if t] + ["a  b", " lead", "x\n\ny", "\n", "don't it's 's", "¾ ² ① 日本", "<|endoftext|> a", "a_b--c,.", "nbsp x", "x\x1cy", "Ünï,\nß."]
    texts += ["".join(r.choices("ab cé'.,\n\t1ßA", k=r.randint(1, 40))) for _ in range(2000)]
    for t in texts:
        assert e.encode(t) == e.whole(t), t


def test_encoder_equals_an_untouched_library():
    from tokenizers import Tokenizer

    path = bpe.vocabulary_path(None)
    plain, e = Tokenizer.from_file(path), bpe.WordEncoder(path, 50)
    for t in ["x <|endoftext|> y", "<|endoftext|>", "a<|endoftext|>b, c", "a\n<|endoftext|>\nb <|endoftext|>", "<|endoftext |> a", "plain words, here", "two  blanks", *(t for _, t in EDGE if t)]:
        ids_ = plain.encode(t, add_special_tokens=False).ids
        assert e.encode(t) == struct.pack(f"<{len(ids_)}I", *ids_), t


def test_token_files(spark, edge, empty, monkeypatch):
    monkeypatch.setattr(token_store, "FLUSH_IDS", 30000)
    rows = token_store.token_files(spark, edge).orderBy("start").collect()
    want = sorted(EDGE, key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, x[1] or ""))
    at = 0
    for r, (d, t) in zip(rows, want, strict=True):
        own = ids(t) + [2]
        assert tuple(r) == (d, at, len(own), zlib.crc32(struct.pack(f"<{len(own)}I", *own)))
        at += len(own)
    assert token_store.token_files(spark, empty).count() == 0


# 8 Sharding


def test_compaction(spark, edge):
    table = sharding.ShardTable(spark, sharding.new_dir(spark, "shard-test"), target_bytes=1 << 20, fan_in=4)
    for n in range(3):
        assert table.append(edge.withColumn("n", F.lit(n))) == n + 1
    before = table.manifest().count()
    old = table.last()
    last = table.settle()
    assert last > old and table.manifest().count() < before
    want = sorted([(*x, n) for n in range(3) for x in EDGE], key=str)
    assert sorted([(r["doc_id"], r["text"], r["n"]) for r in table.read().collect()], key=str) == want
    assert table.manifest().agg(F.sum("n_rows")).first()[0] == len(want)
    with pytest.raises(sharding.ConcurrentCommit):
        table._commit(table.manifest(), last - 1, table._version(last)[1])
    assert table.last() == last and table.read().count() == len(want)


def test_versions_are_whole_or_not_there(spark, edge, monkeypatch):
    table = sharding.ShardTable(spark, sharding.new_dir(spark, "shard-test"))
    table.append(edge)
    monkeypatch.setattr(table, "_move", lambda source, target: (_ for _ in ()).throw(RuntimeError("the writer dies here")))
    with pytest.raises(RuntimeError, match="dies"):
        table.append(edge)
    monkeypatch.undo()
    fs, planted = table._fs(f"{table.folder}/versions/.half-written")  # a writer that died while it wrote
    stream = fs.create(planted)
    stream.write(bytearray(b"manifests/x"))
    stream.close()
    assert table.last() == 1 and table.read().count() == len(EDGE)
    assert table.append(edge) == 2 and table.read().count() == 2 * len(EDGE)
    one, two = (spark.range(1).select(F.lit(f"p{i}").alias("path"), F.lit(1).cast("long").alias("bytes"), F.lit(1).cast("long").alias("n_rows"), F.lit(0).alias("tier")) for i in (1, 2))
    assert table._commit(one, 2, "{}") == 3
    with pytest.raises(sharding.ConcurrentCommit):
        table._commit(two, 2, "{}")
    assert [r["path"] for r in table.manifest().collect()] == ["p1"]


def test_shards_are_read_from_the_manifest_where_they_are_many(spark, edge, monkeypatch):
    table = sharding.ShardTable(spark, sharding.new_dir(spark, "shard-test"))
    table.append(edge)
    want = sorted(map(tuple, table.read().collect()), key=str)
    monkeypatch.setattr(sharding, "LISTED_SHARDS", 0)
    assert sorted(map(tuple, table.read().collect()), key=str) == want
    assert sorted(((r["text"], r["doc_id"]) for r in table.read(columns=["text", "doc_id"]).collect()), key=str) == sorted(((x[1], x[0]) for x in want), key=str)
    table.vacuum(grace_seconds=0)
    assert table.read().count() == len(EDGE)


def test_vacuum_takes_old_versions_manifests_and_lists(spark, edge, tmp_path):
    import os

    table = sharding.ShardTable(spark, f"file://{tmp_path}/shards")
    for _ in range(3):
        table.append(edge)
    held = lambda: {k: len([x for x in os.listdir(tmp_path / "shards" / k) if not x.startswith(".")]) for k in ("versions", "manifests", "pending")}
    before, n = held(), table.read().count()
    table.vacuum()
    assert held() == before  # nothing is old enough
    table.vacuum(keep=2, grace_seconds=0)
    assert held() == {"versions": 2, "manifests": 2, "pending": 0} and table.read().count() == n
    table.settle(grace_seconds=0)
    assert table.read().count() == n


def test_move_by_the_file_systems_rename(spark, tmp_path):
    table = sharding.ShardTable(spark, f"file://{tmp_path}")
    for name in ("a", "b"):
        (tmp_path / name).write_text(name)
    hadoop = spark._jvm.org.apache.hadoop.fs
    table._rename(hadoop.Path(f"file://{tmp_path}/a"), hadoop.Path(f"file://{tmp_path}/c"))
    with pytest.raises(Exception, match="exists"):
        table._rename(hadoop.Path(f"file://{tmp_path}/b"), hadoop.Path(f"file://{tmp_path}/c"))
    assert (tmp_path / "c").read_text() == "a"


def test_compaction_of_nothing(spark, edge, empty):
    assert sharding.compacted(spark, empty).count() == 0
    back = sharding.compacted(spark, edge)
    assert back.columns == edge.columns and back.exceptAll(edge).count() == 0 and back.count() == len(EDGE)


# 9 SimHash


def fingerprint_by_force(text, k=3):
    import xxhash

    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    s = [" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def test_simhash_edges(edge, empty):
    rows = sorted([tuple(r) for r in simhash.near_duplicates(edge).collect()], key=str)
    want = [(d, f"{fingerprint_by_force(t):016x}", {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 6, 7: 7, 8: 8, 9: 9}.get(d) if d else (1 if not t else None)) for d, t in EDGE]
    assert rows == sorted(want, key=str)
    assert simhash.near_duplicates(empty).count() == 0
    kept = simhash.keep_first(edge)
    assert kept.columns == edge.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted([1, 4, 6, 7, 8, 9, None], key=str)


def similar_by_force(rows, similarity=0.8):
    """The smallest ids of the groups of texts alike by shingles of five words; texts without shared words are found by index."""
    sets, index, root = {}, collections.defaultdict(list), {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for d, t in rows:
        w = (t or "").encode().lower().split()
        mine = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}
        for e, n in collections.Counter(e for s in mine for e in index[s]).items():
            if n >= similarity * (len(mine) + len(sets[e]) - n):
                a, b = find(d), find(e)
                root[max(a, b)] = min(a, b)
        find(d)
        sets[d] = mine
        for s in mine:
            index[s].append(d)
    return [d for d, _ in rows if find(d) == d]


def test_similar_texts_like_brute_force(spark, monkeypatch):
    r = random.Random(4)
    rows = [(i, words(r.randint(5, 200), 1000 + i)) for i in range(60)]
    for g in range(6):  # groups of near copies, some of them chains, and exact copies in other case
        base = words(r.randint(60, 300), 2000 + g).split()
        for k in range(12):
            own = list(base)
            own[r.randrange(len(own))] = f"new{g}{k}"
            if g % 2:
                base = own
            rows.append((100 + g * 20 + k, " ".join(own)))
        rows.append((100 + g * 20 + 15, " ".join(base).upper() + "  "))
    monkeypatch.setattr(substring_dedup, "BUCKET_ROWS", 5)
    kept = simhash.keep_first(docs_of(spark, rows)).select("doc_id").collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(similar_by_force(rows))


@pytest.mark.parametrize("edit", ["appended", "cut", "replaced"])
def test_similar_texts_with_passages_changed(spark, edit):
    r, rows = random.Random(7), []
    for g, goal in enumerate([0.8, 0.805, 0.81, 0.82, 0.85, 0.9] * 12):
        base = words(r.randint(60, 400), 5000 + g).split()
        n, at = len(base) - 4, r.randrange(len(base) // 2)
        if edit == "appended":
            own = base + words(int(n / goal - n), 6000 + g).split()
        elif edit == "cut":
            own = base[: len(base) - int(n * (1 - goal))]
        else:
            k = max(int(n * (1 - goal) / (1 + goal)) - 4, 1)
            own = base[:at] + words(k, 7000 + g).split() + base[at + k :]
        rows += [(2 * g, " ".join(base)), (2 * g + 1, " ".join(own))]
    kept = simhash.keep_first(docs_of(spark, rows)).select("doc_id").collect()
    want = similar_by_force(rows)
    assert sorted(r["doc_id"] for r in kept) == sorted(want) and len(want) < 80


@pytest.mark.parametrize("blocks,rows", [(4, 4096), (4, 16), (5, 4096), (6, 32)])
def test_links_like_brute_force(spark, blocks, rows):
    r = random.Random(blocks)
    fps = [r.getrandbits(64) for _ in range(150)]
    base = r.getrandbits(64)
    for _ in range(120):  # a dense group and a chain
        fps.append(base ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)))
    for _ in range(60):
        fps.append(fps[-1] ^ sum(1 << b for b in r.sample(range(64), 3)))
    fps = sorted(set(fps))
    signed = [simhash._signed(x) for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long").repartition(3)
    found = components.connected_components(simhash.links(df, 3, blocks, rows)).collect()
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(fps)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 3:
                root[max(find(a), find(b))] = min(find(a), find(b))
    groups = collections.defaultdict(set)
    for i, x in enumerate(signed):
        groups[find(i)].add(x)
    got = collections.defaultdict(set)
    for x in found:
        got[x["component"]].add(x["node"])
    assert sorted(map(sorted, got.values())) == sorted(sorted(g) for g in groups.values() if len(g) > 1)
    assert all(min(g) == c for c, g in got.items())


@pytest.mark.parametrize("light", [1000, 3])
def test_components(spark, monkeypatch, light):
    monkeypatch.setattr(components, "LIGHT", light)  # 3: the nodes of many edges are broadcast
    r = random.Random(1)
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5000, 5000), (None, 3)] + [(r.randrange(2000, 2100), r.randrange(2000, 2100)) for _ in range(150)]
    got = {x["node"]: x["component"] for x in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    assert got == {x: find(x) for x in list(root)}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_units_let_every_pair_meet(spark):
    df = spark.createDataFrame([(k, i) for k, n in ((1, 50), (2, 3)) for i in range(n)], "key long, m long")
    units, links = buckets.in_units(df, "key", "m", 10)
    met = units.groupBy("key", "unit").agg(F.collect_list("m").alias("m")).collect()
    pairs = {(r["key"], a, b) for r in met for a in r["m"] for b in r["m"] if a < b}
    assert len(pairs) == 50 * 49 // 2 + 3 and max(len(r["m"]) for r in met) < 40 and links is None


def _apart(x, y):
    return F.abs(x - y)


def _met(units):
    return units.groupBy("key", "unit").agg(F.collect_list(F.struct("m", "v")).alias("m")).collect()


def test_units_of_copies_are_few(spark):
    rows = [(1, i, 0 if i < 900 else 10 * i) for i in range(930)] + [(2, i, 5) for i in range(400)] + [(3, i, i) for i in range(7)]
    df = spark.createDataFrame(rows, "key long, m long, v long")
    units, links = buckets.in_units(df, "key", "m", 50, payload="v", distance=_apart, reach=0)
    met = _met(units)
    pairs = {(r["key"], min(a, b)[0], max(a, b)[0]) for r in met for a in r["m"] for b in r["m"] if a != b}
    assert {(1, a, b) for b in range(900, 930) for a in range(900, b)} <= pairs and len([p for p in pairs if p[0] == 3]) == 21
    assert not any(r["key"] == 2 for r in met) and sum(len(r["m"]) for r in met) == 30 + 7
    assert {(r["a"], r["b"]) for r in links.collect()} == {(0, b) for b in (*range(1, 900),)} | {(0, b) for b in range(1, 400)}


@pytest.mark.parametrize("n", [1000, 2000, 4000])
def test_units_grow_with_the_copies(spark, n):
    df = spark.createDataFrame([(1, i, i % 10 * 100) for i in range(n)], "key long, m long, v long")  # ten groups
    units, links = buckets.in_units(df, "key", "m", 100, payload="v", distance=_apart, reach=3)
    assert units.count() <= n and links.count() >= n - 10 * 100 - 10


@pytest.mark.parametrize("seed", range(3))
def test_units_lose_no_component(spark, seed):
    r = random.Random(seed)
    points = [r.choice([r.randrange(60), r.randrange(3000), 7, 500 + r.randrange(8)]) for _ in range(600)]
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate(points)], "key long, m long, v long")
    units, links = buckets.in_units(df, "key", "m", 20, payload="v", distance=_apart, reach=2)
    root = list(range(len(points)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    found = [(x["a"], x["b"]) for x in links.collect()]
    assert all(abs(points[a] - points[b]) <= 2 for a, b in found)
    found += [(a["m"], b["m"]) for x in _met(units) for a in x["m"] for b in x["m"] if abs(a["v"] - b["v"]) <= 2]
    for a, b in found:
        root[max(find(a), find(b))] = min(find(a), find(b))
    order = sorted(range(len(points)), key=lambda i: points[i])
    for a, b in zip(order, order[1:]):
        assert (find(a) == find(b)) == (points[b] - points[a] <= 2)


def test_broadcast_is_bound_by_bytes(spark):
    from wordloom.llm import common

    rows = spark.createDataFrame([(i, [i] * 100, "x" * 50, b"y" * 10, [("a", 1)]) for i in range(20)], "k long, l array<long>, t string, b binary, s array<struct<a:string,n:int>>")
    told = rows.agg(F.sum(common.row_bytes(rows))).first()[0]
    assert 20 * 900 < told < 20 * 1100
    held = lambda df: "broadcast" in df._jdf.queryExecution().logical().toString().lower()
    assert held(common.small(rows)) and not held(common.small(rows, 19)) and not held(common.small(rows, most_bytes=told - 1))


# 10 Quality


def test_quality_like_brute_force(edge, empty):
    rows = sorted(quality.quality_rules(edge).collect(), key=lambda r: (str(r["doc_id"]), r["n_words"]))
    want = []
    for d, t in EDGE:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        c = collections.Counter(zip(w, w[1:], w[2:]))
        hit = {j for i in range(len(w) - 2) if c[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
        failed = len(w) < 50 or 100 * len(hit) > 50 * len(w)
        want.append((d, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit), failed))
    want.sort(key=lambda x: (str(x[0]), x[1]))
    assert [tuple(r)[:7] for r in rows] == want
    assert quality.quality_rules(empty).count() == 0
    kept = quality.keep_good(edge)
    assert kept.columns == edge.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == ["4", "4", "5", "7", "None"]


def test_compression_bands(spark):
    noise = "".join(random.Random(1).choices(string.ascii_letters + string.digits + "+/", k=9000))
    noise = " ".join(noise[i : i + 70] for i in range(0, 9000, 70))
    loop = " ".join(f"{words(40, 3)}" for _ in range(200))
    good = words(3000, 5)
    judged = {r["doc_id"]: r for r in quality.quality_rules(docs_of(spark, [(1, noise), (2, loop), (3, good)])).collect()}
    assert judged[3]["kept"] and not judged[2]["kept"] and judged[2]["whole_ratio"] < 0.05
    assert quality.outside(5000, 0.95, quality.WHOLE_BANDS) and not quality.outside(100, 1.4, quality.WHOLE_BANDS)


@pytest.mark.parametrize("kb", [1, 4, 8, 16])
def test_noise_and_prose_by_length(spark, data, kb):
    import base64

    import zstandard

    r, size, packer = random.Random(kb), kb << 10, zstandard.ZstdCompressor(level=quality.LEVEL)
    dump = "\n".join(base64.b64encode(r.randbytes(57)).decode() for _ in range(size // 77 + 1))[:size]
    printable = "".join(r.choices(string.ascii_letters + string.digits + string.punctuation + " ", k=size))
    some = [x["text"] for x in spark.read.parquet(f"{data}/documents.parquet").where("n_chars > 600").orderBy("doc_id").collect()]
    whole = [" ".join(t for t in some[i:] if quality.repeated_lines(t) == 0)[:size] for i in range(0, 40, 8)]
    for text in (dump, printable):
        assert quality.compression(text.encode(), packer)[2]
    for text in (words(size // 4, kb)[:size], *whole):
        assert not quality.compression(text.encode(), packer)[2]
    kept = {x["doc_id"]: x["kept"] for x in quality.quality_rules(docs_of(spark, [(1, dump), (2, words(size // 4, kb)[:size])])).collect()}
    assert kept == {1: False, 2: True}


def test_noise_in_chunks():
    import zstandard

    r, packer = random.Random(5), zstandard.ZstdCompressor(level=quality.LEVEL)
    noise = lambda n: "".join(r.choices(string.ascii_letters + string.digits + "+/", k=n))
    whole, share, rejected = quality.compression((noise(3 * 4096) + (PROSE * 80)[: 2 * 4096]).encode(), packer)
    assert share >= 0.6 and rejected and not quality.outside(5 * 4096, whole, quality.WHOLE_BANDS)
