"""The Merkle manifest against one that is built node by node."""

import collections
import hashlib
import random
import zlib

import pytest

from wordloom.llm import merkle

DDL = "doc_id long, source string, lang string, n_chars int, text string, tree string, rank long, digest string, root string, block int, N int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, lower=False):
    doc_id, source, lang, n_chars, text = row
    if lower and text is not None:
        text = "".join(c.lower() if c.isascii() else c for c in text)
    parts = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)]
    return sha("".join(parts))


def levels(digests):
    out = [digests]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + 16])) for i in range(0, len(out[-1]), 16)])
    return out


def by_force(rows):
    groups = collections.defaultdict(list)
    for row in rows:
        groups[row[1]].append(row)
    trees = {}
    for source, own in groups.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[source] = levels([leaf_of(r) for r in own])
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    top = levels([trees[s][-1][0] for s in order])
    root = top[-1][0]
    out = []
    for source, own in groups.items():
        for i, row in enumerate(own):
            hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            siblings, folded = "", leaf_of(row, hit)
            for tree, at in ((trees[source], i), (top, order.index(source))):
                for level in tree[:-1]:
                    run = list(level[at // 16 * 16 : at // 16 * 16 + 16])
                    siblings += "".join(run[: at % 16] + run[at % 16 + 1 :])
                    run[at % 16] = folded
                    folded = sha("".join(run))
                    at //= 16
            out.append((row[0], leaf_of(row), trees[source][-1][0], root, sha(siblings), folded, folded == root))
    return sorted(out, key=str)


def rows_of(n, sources, seed):
    r = random.Random(seed)
    out = []
    for i in range(n):
        source = None if r.random() < 0.05 else "hot" if r.random() < 0.4 else r.choice(sources)
        text = r.choice([None, "", "no capitals", f"Capitals {i}", "ÄÖ Ünï", "x" * 5000])
        out.append((r.choice([None, i, i, i, i, i - 1]), source, r.choice([None, "", "en"]), r.choice([None, i]), text))
    return out + out[:5]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "t", 7, "d", "r", 1, 2) for r in rows], DDL).repartition(5)


@pytest.mark.parametrize(("n", "n_sources", "depth"), [(1, 1, 3), (17, 1, 1), (300, 3, 1), (700, 40, 1), (900, 300, 2), (600, 20, 3)])
def test_manifest_like_brute_force(spark, n, n_sources, depth):
    rows = rows_of(n, ["", "=", "-", *(f"s{i}" for i in range(n_sources - 1))], n)
    got = merkle.manifest(frame(spark, rows), depth)
    assert sorted(map(tuple, got.collect()), key=str) == by_force(rows)


def test_one_row_and_none(spark):
    row = (9, None, None, None, None)
    got = merkle.manifest(frame(spark, [row])).collect()
    assert [tuple(r) for r in got] == by_force([row])
    assert got[0].leaf == got[0].subroot == got[0].root == got[0].folded_root and got[0].proof_sha256 == sha("")
    assert merkle.manifest(frame(spark, [row]).limit(0)).collect() == []


def test_tampering_shows_where_the_text_has_capitals(spark):
    rows = [(i, "s", "en", 1, "Some Text" if i % 2 else "some text") for i in range(200)]
    for r in merkle.manifest(frame(spark, rows)).collect():
        assert r.verified == (zlib.crc32(str(r.doc_id).encode()) % 5 != 0 or r.doc_id % 2 == 0)
