"""Aligned tokens against an alignment offset by offset."""

import collections
import hashlib
import itertools
import random

import numpy as np
import pytest

from wordloom.llm import token_alignment as ta

DDL = "doc_id long, text string, row int, codes string, times int, n_a string, Code int"
ODD = ["a  b", " x", "x ", "a\nb", "a\n\nb", "\n", " ", "it's 's ''s", "▁x", "a▁ b", "a ▁", "<|endoftext|> <s></s>", "x<|endoftext|>", "\x00", "a b", "a\u0085b", "a\tb", "Ünï é é 日本語 😀", "x\r\ny", "<0x41>", "12345 123abc!?", "!!! ...", "a\n b", "a \nb", None, "", None, "﻿x", "ﬁ", "word\nword word", "x" * 30000, "日本語" * 300, "\x1cx y", "'", "\n'll"]


def frame(spark, rows):
    return spark.createDataFrame([(d, t, 1, "c", 2, "n", 3) for d, t in rows], DDL).repartition(4)


@pytest.fixture(scope="module")
def own():
    return ta.Aligner(*ta.vocabularies(None, None), 1000)


def groups_by_force(own, text):
    """[(A ids, B ids)] of each group, or None where a text has no tokens."""
    if not text:
        return None
    a, b = own.a.encode(" " + text, add_special_tokens=False).ids, own.b.encode(text)
    a_bytes, b_bytes = [own.a_bytes[i] for i in a], [own.b_bytes[i] for i in b]
    if not b"".join(a_bytes) == (" " + text).encode() == b"".join(b_bytes):
        return None
    a_ends, b_ends = (list(itertools.accumulate(map(len, x))) for x in (a_bytes, b_bytes))
    shared = sorted({*a_ends} & {*b_ends})
    out = [([], []) for _ in shared]
    for ids, ends, side in ((a, a_ends, 0), (b, b_ends, 1)):
        for i, end in zip(ids, ends):
            out[next(n for n, s in enumerate(shared) if s >= end)][side].append(i)
    return out


def by_force(own, rows):
    told = [(d, groups_by_force(own, t)) for d, t in rows]
    counts = collections.Counter((a[-1], b[-1]) for _, g in told for a, b in g or ())
    highest = collections.defaultdict(int)
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    out = []
    for d, g in told:
        links = [(a[-1], b[-1]) for a, b in g or ()]
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g or ())
        numbers = (sum(len(a) for a, _ in g or ()), sum(len(b) for _, b in g or ()), len(links), len(links), sum(counts[x] == highest[x[1]] for x in links), sum(counts[x] for x in links))
        out.append((d, *numbers, hashlib.sha256(text.encode()).hexdigest() if links else ""))
    return sorted(out, key=str)


def sample(seed, n):
    r = random.Random(seed)
    vocabulary = ["the", "The", "straße", "naïve", "don't", "café,", "x1y2", "(see", "end).", "https://a.b/c?d=e", "日本", "—", "zzqxv", "Donaudampfschifffahrt"] + ["".join(r.choices("etaoinshr", k=r.randrange(2, 12))) for _ in range(60)]
    return [(d, r.choice([" ", " ", "\n", "  "]).join(" ".join(r.choices(vocabulary, k=r.randrange(1, 9))) for _ in range(r.randrange(1, 12)))) for d in range(n)]


@pytest.mark.parametrize("pairs", [ta.PAIRS, 50])
def test_like_brute_force(spark, own, pairs):
    rows = sample(1, 80) + [(d if d % 5 else None, t) for d, t in enumerate(ODD, 60)] + [(7, "again again"), (7, "again again")]
    got = ta.alignment(frame(spark, rows), memo=40, pairs=pairs)
    assert sorted(map(tuple, got.collect()), key=str) == by_force(own, rows)


def test_documents_like_brute_force(spark, own, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(map(tuple, ta.alignment(docs).collect()), key=str) == by_force(own, rows)


def test_pair_counts(spark, own):
    rows = sample(2, 30)
    want = collections.Counter((a[-1], b[-1]) for _, t in rows for a, b in groups_by_force(own, t) or ())
    got = ta.pair_counts(ta.aligned(frame(spark, rows)).cache(), own.n_b).collect()
    assert {(r.a, r.b): r["count"] for r in got} == dict(want)
    for b in {r.b for r in got}:
        mine = [r for r in got if r.b == b]
        assert {r.a for r in mine if r.best} == {r.a for r in mine if r["count"] == max(x["count"] for x in mine)}


def test_words_as_the_whole_text(own):
    for _, text in sample(3, 200):
        counts, digests, _, codes, times = own.rows([text])
        whole = own._whole(text)
        assert counts[0].tolist() == whole[0].tolist() and digests[0] == hashlib.sha256(whole[1][:-1]).hexdigest()
        assert np.repeat(codes, times).tolist() == sorted(whole[2].tolist())


def test_components_of_random_cuts():
    r = np.random.default_rng(3)
    for _ in range(50):
        n = int(r.integers(1, 60))
        a, b = (np.diff([0, *np.sort(r.choice(np.arange(1, n), r.integers(0, n), replace=False)), n]) for _ in range(2))
        a_in, b_in, x, y = ta.components_of(a, b)
        cuts = np.intersect1d(np.cumsum(a), np.cumsum(b))
        assert a_in.tolist() == np.searchsorted(cuts, np.cumsum(a)).tolist() and b_in.tolist() == np.searchsorted(cuts, np.cumsum(b)).tolist()
        assert np.cumsum(a)[x].tolist() == np.cumsum(b)[y].tolist() == cuts.tolist()


def test_empty(spark):
    assert ta.alignment(frame(spark, [(1, "a")]).limit(0)).collect() == []
