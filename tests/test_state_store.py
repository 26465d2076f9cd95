"""The versioned state table and staged publication: conflicts, lost writers, refusals."""

import threading

import pytest
from pyspark.sql import functions as F

from wordloom.operators import integrity
from wordloom.sources import state_store
from wordloom.sources.state_store import Files, StaleState, StateStore, UnsoundState

DDL = "k long, state string, history array<string>, note string"


@pytest.fixture
def store(spark, tmp_path):
    return StateStore(spark, f"file://{tmp_path}/states", DDL, "k")


def rows(spark, *given):
    return spark.createDataFrame([(k, h.split(">")[-1], h.split(">"), n) for k, h, n in given], DDL)


def held(store, version=None):
    return {r["k"]: (">".join(r["history"]), r["note"]) for r in store.load(version)[0].collect()}


def test_load_and_save(spark, store):
    assert store.load()[1] == 0 and held(store) == {}
    one = store.save(rows(spark, (1, "GENERATED", "a"), (2, "GENERATED", "b")), 0)
    two = store.save(rows(spark, (2, "GENERATED>REVIEWING", None), (3, "GENERATED", "c")), one)
    assert held(store) == {1: ("GENERATED", "a"), 2: ("GENERATED>REVIEWING", None), 3: ("GENERATED", "c")}
    assert held(store, one) == {1: ("GENERATED", "a"), 2: ("GENERATED", "b")}
    assert store.fingerprint(one) != store.fingerprint(two) == store.fingerprint()
    assert store.save(rows(spark), two) == 3 and store.fingerprint() == store.fingerprint(two)


def test_one_of_two_writers_wins(spark, store):
    store.save(rows(spark, (1, "GENERATED", "a")), 0)
    results = []

    def write(note):
        try:
            results.append((store.save(rows(spark, (1, "GENERATED>REVIEWING", note)), 1), note))
        except StaleState:
            results.append((None, note))

    writers = [threading.Thread(target=write, args=(n,)) for n in "xyz"]
    [w.start() for w in writers]
    [w.join() for w in writers]
    won = [n for v, n in results if v == 2]
    assert len(won) == 1 and held(store) == {1: ("GENERATED>REVIEWING", won[0])} and store.versions() == [1, 2]


def test_a_lost_writer_leaves_the_last_version(spark, store, monkeypatch):
    store.save(rows(spark, (1, "GENERATED", "a")), 0)
    with monkeypatch.context() as m:
        m.setattr(Files, "create", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            store.save(rows(spark, (1, "GENERATED>REVIEWING", "lost")), 1)
    assert held(store) == {1: ("GENERATED", "a")} and store.last() == 1
    assert len(store.files.names(f"{store.folder}/data")) == 2
    assert store.vacuum() == 0 and store.vacuum(grace_seconds=0) == 1
    assert store.save(rows(spark, (1, "GENERATED>REVIEWING", "again")), 1) == 2


def test_stale_and_unsound(spark, store):
    store.save(rows(spark, (1, "GENERATED", "a")), 0)
    with pytest.raises(StaleState):
        store.save(rows(spark, (2, "GENERATED", "b")), 0)
    bad = {
        "illegal_step": (1, "GENERATED>ACCEPTED", None), "history_starts_elsewhere": (5, "REVIEWING", None), "unknown_state": (5, "GENERATED>LOST", None),
        "unknown_in_history": (5, "GENERATED>LOST>REVIEWING", None), "no_key": (None, "GENERATED", None), "history_rewritten": (1, "GENERATION_FAILED>GENERATED", None),
    }
    for rule, row in bad.items():
        with pytest.raises(UnsoundState) as refused:
            store.save(rows(spark, (7, "GENERATED", "sound"), row), 1)
        assert refused.value.counts[rule] == 1
    with pytest.raises(UnsoundState) as refused:
        store.save(rows(spark, (7, "GENERATED", "x"), (7, "GENERATED", "y")), 1)
    assert refused.value.counts == {"repeated_key": 2}
    for column, rule in ((F.lit("REVIEWING"), "history_ends_elsewhere"), (F.lit(None).cast("string"), "unknown_state")):
        with pytest.raises(UnsoundState) as refused:
            store.save(rows(spark, (8, "GENERATED", "x")).withColumn("state", column), 1)
        assert rule in refused.value.counts
    with pytest.raises(UnsoundState) as refused:
        store.save(rows(spark, (8, "GENERATED", "x")).withColumn("history", F.lit(None).cast("array<string>")), 1)
    assert "no_history" in refused.value.counts
    assert held(store) == {1: ("GENERATED", "a")} and store.versions() == [1]


def test_many_versions(spark, store, monkeypatch):
    monkeypatch.setattr(state_store, "MAX_CHANGES", 2)
    at, want = 0, {}
    for n in range(7):
        given = [(k, "GENERATED", f"{n}") for k in range(n, n + 3)]
        want |= {k: (h, note) for k, h, note in given}
        at = store.save(rows(spark, *given), at)
        assert held(store) == want
    assert len(store._listed(at)) <= 3
    store.vacuum(keep=1, grace_seconds=0)
    assert held(store) == want and store.versions() == [7]


def test_publish_resumes(spark, tmp_path, monkeypatch):
    tables = {n: spark.range(20).select(F.col("id"), F.lit(n).alias("t")) for n in ("a", "b")}
    run = f"file://{tmp_path}/run"
    write = Files.create
    with monkeypatch.context() as m:
        m.setattr(Files, "create", lambda self, path, text: write(self, path, text) if "table-b" not in path else (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            integrity.publish(tables, "", run)
    assert [tuple(r) for r in integrity.verify(spark, run).collect()] == [("COMPLETE", "missing")]
    with pytest.raises(ValueError, match="publishes"):
        integrity.publish({"c": tables["a"]}, "", run)
    before = {r["path"] for r in spark.read.format("binaryFile").load(f"{run}/data/a").collect()}
    assert integrity.publish(tables, "", run) == run
    assert before == {r["path"] for r in spark.read.format("binaryFile").load(f"{run}/data/a").collect()}  # the whole table was kept
    assert integrity.verify(spark, run).collect() == [] and spark.read.json(f"{run}/data/b").count() == 20
    with pytest.raises(ValueError, match="complete"):
        integrity.publish(tables, "", run)


def test_verified_union_refuses(spark, tmp_path):
    folder, columns = f"file://{tmp_path}", {"k": F.col("id"), "t": F.col("t")}
    table = lambda *ids: spark.createDataFrame([(i, "x") for i in ids], "id long, t string")
    run = lambda *ids: integrity.publish({"items": table(*ids)}, folder)
    union = lambda **runs: integrity.verified_union(spark, {n: (r, "items", "id long, t string", columns) for n, r in runs.items()}, "k")
    good = run(1, 2)
    assert sorted(map(tuple, union(b=run(2, 3), a=good).collect())) == [("a", 1, "x"), ("a", 2, "x"), ("b", 2, "x"), ("b", 3, "x")]
    for ids in ((1, 1), (1, None)):
        with pytest.raises(integrity.UnverifiedRun, match="repeated"):
            union(a=good, b=run(*ids))
    with pytest.raises(integrity.UnverifiedRun, match="no items"):
        union(a=good, b=run())
    changed, lacking = run(5), run(6)
    [part] = [p for p in (tmp_path / changed.rpartition("/")[2] / "data" / "items").iterdir() if p.name.startswith("part-") and p.stat().st_size]
    part.write_text('{"id":9,"t":"x"}\n')
    (part.parent / f".{part.name}.crc").unlink(missing_ok=True)
    with pytest.raises(integrity.UnverifiedRun, match="b: part.*changed"):
        union(a=good, b=changed)
    (tmp_path / lacking.rpartition("/")[2] / "status" / "COMPLETE").unlink()
    with pytest.raises(integrity.UnverifiedRun, match="COMPLETE missing"):
        union(a=good, b=lacking)


def test_no_keys_are_broadcast(spark, store):
    """Parquet of keys is small for its rows: at nine million orders their broadcast filled the driver."""
    one = store.save(rows(spark, (1, "GENERATED", "a"), (2, "GENERATED", "b")), 0)
    two = store.save(rows(spark, (2, "GENERATED>REVIEWING", None)), one)
    for made in (store.load(two)[0], store.broken(store.load(two)[0], two)):
        made.collect()
        assert "Broadcast" not in made._jdf.queryExecution().executedPlan().toString()
