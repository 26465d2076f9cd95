"""Boxes against flood fill, relabelled JSON against Python's, digest trees against changed files."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from wordloom.functions import json_text
from wordloom.operators import graph, grid
from wordloom.sources import file_tree


def flooded(cells):
    left, out = set(cells), []
    while left:
        queue, seen = [left.pop()], []
        while queue:
            x, y = queue.pop()
            seen.append((x, y))
            near = {(x + a, y + b) for a in (-1, 0, 1) for b in (-1, 0, 1)} & left
            left -= near
            queue += near
        xs, ys = [c[0] for c in seen], [c[1] for c in seen]
        out.append((min(xs), max(xs) + 1, min(ys), max(ys)))
    return sorted(out)


@pytest.mark.parametrize("share", [0.15, 0.35, 0.6])
def test_boxes_like_flood_fill(spark, share):
    r = random.Random(int(share * 100))
    grids = {g: {(x - 5, y) for x in range(90) for y in range(14) if r.random() < share} for g in ("a", "b")}
    rows = [(g, x, y) for g, cells in grids.items() for x, y in cells] + [("a", None, 3), ("b", 4, None)]
    got = grid.boxes(spark.createDataFrame(rows + rows[:9], "g string, x long, y long"), ["g"], 0, 1, 1, 0, 1, 99).collect()
    for g, cells in grids.items():
        assert sorted((b.left, b.right, b.top, b.bottom) for b in got if b.g == g) == flooded(cells)


def test_gaps_slack_and_limits(spark):
    rows = [("g", x, 0) for x in (0, 1, 4, 5, 20, 21)] + [("g", x, 2) for x in (8, 9, 10, 11, 12)] + [("g", 40, y) for y in range(9)] + [("g", x, 5) for x in range(60, 64)]
    points = spark.createDataFrame(rows, "g string, x long, y long")
    take = lambda *limits: sorted((b.left, b.right, b.top, b.bottom, b.n_runs) for b in grid.boxes(points, ["g"], *limits).collect())
    assert take(2, 2, 2, 2, 4, 6) == [(0, 13, 0, 2, 2), (60, 64, 5, 5, 1)]
    assert take(2, 1, 1, 2, 1, 99) == [(0, 6, 0, 0, 1), (8, 13, 2, 2, 1), (20, 22, 0, 0, 1), (40, 41, 0, 8, 9), (60, 64, 5, 5, 1)]
    assert grid.boxes(points.limit(0), ["g"], 0, 1, 1, 0, 1, 9).collect() == []


def plain_boxes(points, max_gap, least_run, rows_apart, slack):
    runs = []
    for y in {y for _, y in points}:
        xs = sorted({x for x, at in points if at == y})
        cuts = [i for i in range(1, len(xs)) if xs[i] - xs[i - 1] > max_gap + 1]
        runs += [(y, xs[i], xs[j - 1] + 1) for i, j in zip([0, *cuts], [*cuts, len(xs)]) if xs[j - 1] + 1 - xs[i] >= least_run]
    root = {run: run for run in runs}

    def find(run):
        while root[run] != run:
            run = root[run]
        return run

    for a in runs:
        for b in runs:
            if 0 < b[0] - a[0] <= rows_apart and b[2] >= a[1] - slack and b[1] <= a[2] + slack:
                root[find(a)] = find(b)
    held = {}
    for run in runs:
        held.setdefault(find(run), []).append(run)
    return sorted((min(r[1] for r in h), max(r[2] for r in h), min(r[0] for r in h), max(r[0] for r in h), len(h)) for h in held.values())


@pytest.mark.parametrize("limits", [(0, 1, 1, 0), (1, 2, 3, 2), (3, 2, 2, 5), (0, 1, 70, 0), (2, 1, 1, 70)])
def test_boxes_over_tiles(spark, limits):
    r = random.Random(sum(limits))
    spread = {("a", 1): (200, 150, 1500), ("a", 2): (70, 70, 900), ("b", 1): (900, 4, 600), ("b", 2): (3, 400, 500)}
    grids = {g: {(r.randrange(w) - w // 2, r.randrange(h) - h // 2) for _ in range(n)} for g, (w, h, n) in spread.items()}
    grids["b", 1] |= {(x, 0) for x in range(-300, 300)}
    grids["c", 1] = {(10**15 + 63 + i // 2, -(10**9) + (i + 1) // 2) for i in range(140)}
    rows = [(*g, x, y) for g, cells in grids.items() for x, y in cells]
    got = grid.boxes(spark.createDataFrame(rows, "g string, h int, x long, y long"), ["g", "h"], *limits, 1, 10**6).collect()
    for g, cells in grids.items():
        assert sorted((b.left, b.right, b.top, b.bottom, b.n_runs) for b in got if (b.g, b.h) == g) == plain_boxes(cells, *limits)


def test_boxes_join_over_tables_what_crosses_tiles_alone(spark, monkeypatch):
    joined = []
    monkeypatch.setattr(grid, "components", lambda nodes, links: joined.append(nodes.count()) or graph.components(nodes, links))
    within = spark.createDataFrame([(g, x, y) for g in range(20) for y in range(30) for x in (2, 9 + y % 3)], "g long, x long, y long")
    assert sorted(b.n_runs for b in grid.boxes(within, ["g"], 0, 1, 1, 0, 1, 99).collect() if b.left == 2) == [30] * 20
    assert joined == [0]
    down = spark.createDataFrame([(g, 2, y) for g in range(20) for y in range(100)] + [(1, 40, 5)], "g long, x long, y long")
    assert sorted(tuple(b) for b in grid.boxes(down, ["g"], 0, 1, 1, 0, 1, 99).collect()) == sorted([(g, 2, 3, 0, 99, 100) for g in range(20)] + [(1, 40, 41, 5, 5, 1)])
    assert joined == [0, 40]


def test_activity_boxes_of_odd_events(spark, duck, tmp_path):
    from wordloom.plans import catalogue

    r = random.Random(15)
    rows = [(f"2024-{r.randrange(1, 7):02d}-{r.randrange(1, 29):02d} {r.randrange(24):02d}:30:00", r.choice([1, 2, 2, 3, None])) for _ in range(3000)]
    rows += [(None, 1), (None, None), ("2023-12-31 23:00:00", 4), ("2023-12-31 19:00:00", 4), ("2024-01-01 00:00:00", 4), ("2024-01-01 20:00:00", 4)] + [("2023-11-01 05:00:00", 5)] * 9
    events = spark.createDataFrame(rows, "ts string, user_id long").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    events.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    got = sorted(tuple(b) for b in catalogue.queries()["activity_boxes"](spark, str(tmp_path)).collect())
    sql = f"WITH RECURSIVE events AS (SELECT * FROM '{tmp_path}/events.parquet/*.parquet'), " + catalogue.oracle_sql()["activity_boxes"].split("WITH RECURSIVE", 1)[1]
    assert got == sorted(duck.execute(sql).fetchall()) and len(got) > 20


def test_components(spark):
    r = random.Random(3)
    links = [(i, i + 1) for i in range(0, 60)] + [(r.randrange(100, 400), r.randrange(100, 400)) for _ in range(150)] + [(7, 7), (None, 3), (900, 5)]
    root = {n: n for n in range(400)}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        if a in root and b in root:
            root[max(find(a), find(b))] = min(find(a), find(b))
    nodes = spark.range(400).select(F.col("id").alias("n"))
    got = graph.components(nodes, spark.createDataFrame(links, "a long, b long")).collect()
    assert {x.node: x.component for x in got} == {n: find(n) for n in root}


def by_python(value, mapping, keys):
    if isinstance(value, dict):
        return {k: mapping.get(v, v) if k in keys and isinstance(v, str) else by_python(v, mapping, keys) for k, v in value.items()}
    return [by_python(v, mapping, keys) for v in value] if isinstance(value, list) else value


def any_json(r, depth):
    kind = r.randrange(8 if depth else 5)
    if kind > 4:
        if kind == 5:
            return [any_json(r, depth - 1) for _ in range(r.randrange(4))]
        keys = ["answer_key", "correct_answer", "Answer_Key", "answer_keys", 'x"answer_key', "answer_key\\", "ä", "", "n"]
        return {k: any_json(r, depth - 1) for k in r.sample(keys, r.randrange(5))}
    return [r.choice("ABCDE"), r.randrange(9), None, True, r.choice(['"answer_key":"A"', '\\"answer_key\\":\\"A\\"', "answer_key", 'A"', "\\", "A\nB", "", "ü", "x" * 9000])][kind]


def test_relabelled_like_python(spark):
    r, mapping = random.Random(11), {"A": "B", "B": "C", "C": "A", "\\": "!"}
    values = [any_json(r, 5) for _ in range(300)]
    keys = set(json_text.LABEL_KEYS)
    rows = [(i, json.dumps(v, ensure_ascii=bool(i % 2), indent=i % 3 or None)) for i, v in enumerate(values)]
    rows += [(-1, None), (-2, "{broken"), (-3, ""), (-4, '{"answer_\\u006bey" : "\\u0041"}')]
    labels = F.map_from_arrays(F.array(*map(F.lit, mapping)), F.array(*map(F.lit, mapping.values())))
    got = {x.i: x.j for x in spark.createDataFrame(rows, "i long, t string").select("i", json_text.relabelled(F.col("t"), labels).alias("j")).collect()}
    plain = {k: v for k, v in mapping.items() if k != "\\"}  # a label that JSON escapes is in no map
    assert all(json.loads(got[i]) == by_python(v, plain, keys) for i, v in enumerate(values))
    assert got[-1] is got[-2] is got[-3] is None and got[-4] == '{"answer_key":"B"}'


def test_drift_of_files(spark, tmp_path):
    def write(top, names):
        for name, text in names.items():
            os.makedirs(tmp_path / top / os.path.dirname(name), exist_ok=True)
            (tmp_path / top / name).write_bytes(text)
        return file_tree.tree(file_tree.leaves(spark, f"file://{tmp_path}/{top}"))

    names = {f"d{i}/e{j}/f{k}.bin": bytes([i, j, k]) * 50 for i in range(3) for j in range(3) for k in range(4)} | {"top.txt": b"", "d0/x.txt": b"x"}
    frozen, same = write("a", names), write("b", names)
    assert file_tree.drift(frozen, same).collect() == []
    root = lambda t: t.where("path = ''").first().digest
    assert root(frozen) == root(same)
    later = dict(names)
    del later["d1/e0/f0.bin"], later["d2/e1/f0.bin"], later["d2/e1/f1.bin"], later["d2/e1/f2.bin"], later["d2/e1/f3.bin"]
    later |= {"d1/e2/f3.bin": b"other", "d0/new/deep/y.txt": b"y"}
    later["d0/z.txt"] = later.pop("d0/x.txt")  # a name counts too
    now = write("c", later)
    got = {x.path: x.drift for x in file_tree.drift(frozen, now).collect()}
    want = {"": "changed", "d0": "changed", "d1": "changed", "d2": "changed", "d0/x.txt": "missing", "d0/z.txt": "added", "d0/new": "added", "d0/new/deep": "added", "d0/new/deep/y.txt": "added"}
    want |= {"d1/e0": "changed", "d1/e0/f0.bin": "missing", "d1/e2": "changed", "d1/e2/f3.bin": "changed", "d2/e1": "missing", **{f"d2/e1/f{k}.bin": "missing" for k in range(4)}}
    assert got == want
