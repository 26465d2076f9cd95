"""The Jaccard join against all pairs."""

import random

import numpy as np
import pytest

from wordloom.llm import set_join

DDL = "doc_id long, text string, class string, node long, key long, unit int, signatures string, mark int, Least int"


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "c", 1, 2, 3, "s", 4, 5) for d, t in rows], DDL).repartition(4)


def shingles(text):
    w = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    if len(w) < 3:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + 3]) for i in range(len(w) - 2)}


def by_force(rows, over=100, under=90):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and over * len(sets[a] & sets[b]) >= under * len(sets[a] | sets[b]):
                root[max(find(a), find(b))] = min(find(a), find(b))
    least = {}
    for i, (d, _) in enumerate(rows):
        g = find(i)
        least[g] = min((x for x in (least.get(g), d) if x is not None), default=None)
    return sorted(((d, len(s), least[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def near_copies(seed, n_bases=12, copies=8):
    r = random.Random(seed)
    rows = []
    for _ in range(n_bases):
        base = [f"w{r.randrange(3000)}" for _ in range(r.choice([1, 2, 3, 4, 8, 11, 12, 13, 20, 35, 60, 150, 700]))]
        for _ in range(copies):
            own = list(base)
            for _ in range(r.randrange(1 + len(base) // 40 + 1)):
                at = r.randrange(len(own))
                match r.randrange(4):
                    case 0:
                        own[at] = "new"
                    case 1:
                        del own[at:]
                        own = own or ["x"]
                        own += base[at:]
                    case 2:
                        own.insert(at, "more")
                    case _:
                        own += base[: at // 10]
            rows.append((len(rows), r.choice([" ", "\n", " \t"]).join(own)))
    return rows


EDGE = [(1, None), (2, ""), (3, " \n\t"), (4, "A b"), (4, "a B"), (None, "a b"), (None, None), (None, "a b c"), (5, "a b c"), (6, "ä Ä ä Ä"), (7, "Ä ä Ä ä"), (8, "x" * 70000), (9, "x" * 70000), (10, "a b a b a b a b"), (11, "a b a b a b"), (12, "a\u0085b c"), (13, "a b c d"), (14, " ".join(map(str, range(30000)))), (15, " ".join(map(str, range(30500))))]


@pytest.mark.parametrize("seed", range(3))
def test_like_brute_force(spark, seed):
    rows = near_copies(seed) + [(1000 + d if d is not None else d, t) for d, t in EDGE]
    assert sorted(map(tuple, set_join.similar_documents(frame(spark, rows)).collect()), key=str) == by_force(rows)


def test_other_similarities(spark):
    rows = near_copies(9)
    for over, under in ((10, 8), (2, 1), (1, 1)):
        assert sorted(map(tuple, set_join.similar_documents(frame(spark, rows), over, under).collect()), key=str) == by_force(rows, over, under)


def test_many_chunks_of_one_bucket(spark, monkeypatch):
    r = random.Random(4)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for d in range(150):  # a chain: each text is near the last, the ends are far apart
        base[r.randrange(80)] = f"v{d}"
        rows.append((500 - d, " ".join(base)))
    docs = frame(spark, rows)
    signed = set_join._signed(docs, set_join.OVER, set_join.UNDER).cache()
    linked = set_join.linked_classes(docs.select("doc_id", "text"), signed, bucket_rows=8)
    groups = {x["component"] for x in linked.collect()}
    want = by_force(rows)
    assert len(groups) == len({c for _, _, c in want if sum(c == x[2] for x in want) > 1})
    monkeypatch.setattr(set_join, "BUCKET_ROWS", 8)
    assert sorted(map(tuple, set_join.similar_documents(docs).collect()), key=str) == want


def test_empty(spark):
    assert set_join.similar_documents(frame(spark, EDGE).limit(0)).collect() == []


def test_similar_sets_share_a_signature():
    r = np.random.default_rng(7)
    for size in [*range(1, 45), 60, 90, 150, 300, 800, 3000]:
        for _ in range(12):
            x = np.unique(r.integers(0, 1 << 64, size, dtype=np.uint64))
            y = x
            for _ in range(40):  # change it as far as it goes
                keep = r.random(len(y)) > r.choice([0.0, 0.03])
                z = np.unique(np.concatenate([y[keep], r.integers(0, 1 << 64, r.integers(0, 2 + size // 40), dtype=np.uint64)]))
                if not len(z) or 100 * len(np.intersect1d(x, z)) < 90 * len(np.union1d(x, z)):
                    break
                y = z
            assert np.intersect1d(set_join.signatures(x), set_join.signatures(y)).size


def test_nearly_empty_parts_are_left_out_only_within_the_spare():
    even = np.arange(1, 401, dtype=np.uint64) * np.uint64((1 << 64) // 401)
    k = set_join.bands_up_to(512)[1][int(np.searchsorted(set_join.bands_up_to(512)[0], 400))]
    n = set_join.parts_of(k)[0]
    crowded = even[: len(even) // 3]  # two thirds of its parts are empty: all sign
    assert len(set_join.signatures(even)) >= 2 * n - 10
    lasts, most = set_join.bands_up_to(256)
    band = int(np.searchsorted(lasts, len(crowded)))
    assert len(set_join.signatures(crowded)) == sum(set_join.parts_of(most[t])[0] for t in (band, band + 1))


def test_a_hot_signature_reaches_its_bucket_once_a_task(spark):
    rows = [(d, "one text that very many rows have with a word of their own at its end " + "same " * 3) for d in range(50)]
    nodes = spark.createDataFrame([(d, [7, d + 100]) for d, _ in rows], "node long, signatures array<long>").coalesce(1)
    met = nodes.mapInArrow(set_join._gathered(1000), "key long, node long").collect()
    assert sum(r["key"] == 7 for r in met) == 1
    assert {r["component"] for r in set_join.candidates(nodes).collect()} == {0}
    few = nodes.mapInArrow(set_join._gathered(10), "key long, node long")
    assert {r["component"] for r in set_join.connected_components(few.repartition("key").sortWithinPartitions("key", "node").mapInArrow(set_join._linked, "a long, b long")).collect()} == {0}
