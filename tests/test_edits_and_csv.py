"""Edit scripts against dynamic programming; CSV files of unlike records byte by byte."""

import csv
import io
import random

from pyspark.sql import functions as F

from wordloom.operators import edits
from wordloom.plans.audit_queries import mutated
from wordloom.plans import catalogue
from wordloom.sources import records


def common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        row, last = [0], row
        for j, y in enumerate(b):
            row.append(last[j] + 1 if x == y else max(row[-1], last[j + 1]))
    return row[-1]


def holds(a, b, script):
    """Whether a script makes ``b`` of ``a`` and leaves as much as can be left."""
    if len(script) == 1 and script[0].kind == "move":
        o = script[0]
        rest = a[: o.i1] + a[o.i2 :]
        return rest[: o.j1] + a[o.i1 : o.i2] + rest[o.j1 :] == b and len(rest) == common(a, b)
    made, at, kept = [], 0, 0
    for o in script:
        if o.kind != ("insertion" if o.i1 == o.i2 else "deletion" if o.j1 == o.j2 else "substitution"):
            return False
        made += a[at : o.i1]
        kept += o.i1 - at
        if len(made) != o.j1:
            return False
        made += b[o.j1 : o.j2]
        at = o.i2
    return made + a[at:] == b and kept + len(a) - at == common(a, b)


def scripts(spark, pairs):
    rows = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "k int, a array<string>, b array<string>")
    return {r.k: r.s for r in rows.select("k", edits.edit_script(F.col("a"), F.col("b")).alias("s")).collect()}


def test_scripts_like_dynamic_programming(spark):
    r = random.Random(8)
    pairs = [([r.choice("abc") for _ in range(r.randrange(9))], [r.choice("abc") for _ in range(r.randrange(9))]) for _ in range(250)]
    for _ in range(60):
        a = [r.choice("abcdefghij") for _ in range(r.randrange(4, 30))]
        i, j = sorted(r.sample(range(len(a)), 2))
        at = r.randrange(len(a) - (j - i) + 1)
        rest = a[:i] + a[j:]
        pairs.append((a, rest[:at] + a[i:j] + rest[at:]))
    got = scripts(spark, [*pairs, (None, ["a"]), ([], []), ([], ["x"]), (["x"], [])])
    assert all(holds(a, b, got[i]) for i, (a, b) in enumerate(pairs))
    n = len(pairs)
    assert got[n] is None and got[n + 1] == [] and got[n + 2][0].kind == "insertion" and got[n + 3][0].kind == "deletion"
    move = scripts(spark, [("p q x y z".split(), "x y p q z".split())])[0]
    assert len(move) == 1 and move[0].kind == "move"
    assert {o.kind for o in scripts(spark, [("a b c d".split(), "b a d c".split())])[0]} != {"move"}  # two swaps are no move


def test_mutation_scripts(spark, data):
    rows = {(r.conv_id, r.turn): r for r in mutated(spark, data).collect()}
    told = {(r.conv_id, r.turn): r for r in catalogue.queries()["mutation_scripts"](spark, data).collect()}
    assert set(rows) == set(told) and {x for r in told.values() for x in r.errors.split(",")} >= {"", "no_edit", "several_edits", "edit_outside_span", "source_differs", "target_differs"}
    for key, r in rows.items():
        ops = [x.split(":") for x in told[key].script.split(",") if x]
        script = [type("O", (), {"kind": o[0], **dict(zip(("i1", "i2", "j1", "j2"), map(int, o[1:])))}) for o in ops]
        assert holds(r.w, r.v, script)
        if key[1] % 7 < 3 and len(ops) == 1 and "@@" not in r.w and ops[0][0] == r.declared.kind and int(ops[0][3]) == r.declared.start:
            assert told[key].errors == ""


def test_every_mutation_error(spark):
    w = "one two three four five".split()
    declared = lambda kind, source, target, start, end: (kind, source, target, start, end)
    given = {
        1: ("one two X four five".split(), declared("substitution", ["three"], ["X"], 2, 3), ""),
        2: ("one two four five".split(), declared("deletion", ["three"], None, 1, 2), ""),  # its place is the end of the span
        3: ("one two four five".split(), declared("deletion", ["three"], [], 3, 4), "edit_outside_span"),
        4: ("one two X three four five".split(), declared("deletion", [], ["X"], 2, 3), "kind_differs"),
        5: ("one two X four five".split(), declared("substitution", ["four"], ["Y"], 2, 3), "source_differs,target_differs"),
        6: ("X two three four Y".split(), declared("substitution", ["one", "five"], ["X", "Y"], 0, 5), "several_edits"),
        7: (w, declared("substitution", [], [], 0, 1), "no_edit"),
        8: ("one two X four five".split(), declared("substitution", ["three"], ["X"], 2, 2), "edit_outside_span,empty_span"),
        9: ("three four one two five".split(), declared("move", ["three", "four"], ["three", "four"], 0, 2), ""),
    }
    rows = spark.createDataFrame([(k, w, v, d) for k, (v, d, _) in given.items()], "k int, w array<string>, v array<string>, d struct<kind:string,source:array<string>,target:array<string>,start:int,end:int>")
    told = rows.withColumn("s", edits.edit_script(F.col("w"), F.col("v")))
    got = {r.k: r for r in told.select("k", "s", F.array_join(edits.mutation_errors(F.col("w"), F.col("v"), F.col("s"), F.col("d")), ",").alias("e")).collect()}
    move = got[9].s[0]
    want = {k: e for k, (_, _, e) in given.items()}
    if (move.i1, move.i2) != (2, 4):  # the other block may be the one that moves
        want[9] = got[9].e
    assert {k: r.e for k, r in got.items()} == want and move.kind == "move"


def test_csv_of_unlike_records(spark, tmp_path):
    r = random.Random(2)
    cells = ["", "plain", 'q"uote', "a,b", "two\nlines", "\r\n", " blanks ", "ünï", '"', "x" * 3000]
    rows = [(i, {k: r.choice(cells) for k in r.sample(["b", "a", "ä", "c d", 'k"ey', "z,z"], r.randrange(5))}) for i in range(200)]
    path = f"file://{tmp_path}/out/records.csv"
    (tmp_path / "out").mkdir()
    header = records.write_csv_records(spark.createDataFrame(rows, "i int, m map<string,string>").repartition(5), "m", ["i"], path)
    raw = (tmp_path / "out" / "records.csv").read_bytes()
    assert raw.startswith(b"\xef\xbb\xbf") and header == sorted({k for _, m in rows for k in m})
    got = list(csv.reader(io.StringIO(raw.decode("utf-8-sig"), newline="")))
    assert got[0] == header and got[1:] == [[m.get(k, "") for k in header] for _, m in rows]
    assert [x.name for x in (tmp_path / "out").iterdir() if not x.name.startswith(".")] == ["records.csv"]


def test_csv_of_no_records(spark, tmp_path):
    none = spark.createDataFrame([], "i int, m map<string,string>")
    assert records.write_csv_records(none, "m", ["i"], f"file://{tmp_path}/records.csv") == []
    assert (tmp_path / "records.csv").read_text("utf-8-sig").strip() == ""


def test_long_lists_with_many_matches(spark):
    """Both ends changed: all matching positions of 3,000 words count, some 90,000 of them, where their square took hours."""
    r = random.Random(3)
    a = [r.choice([f"w{i}" for i in range(100)]) for _ in range(3000)]
    b = ["@@", *a[1:1500], *a[1510:-1], "@@"]
    assert holds(a, b, scripts(spark, [(a, b)])[0])


def test_the_chain_whose_last_point_comes_first():
    from wordloom.functions.udfs import longest_chain

    assert longest_chain("a b a".split(), "a a b".split()) == [(0, 0), (1, 2)] and longest_chain([None, "x"], ["x", None]) == [(0, 1)]
