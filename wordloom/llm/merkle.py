"""Operator 13: a Merkle manifest of a table, from contiguous digest matrices.

Every row is a leaf; the leaves of a source, by doc_id, are the base of a tree in which runs of
FANOUT nodes become one, and the roots of the sources are the base of the tree above them. A
digest is 64 bytes of hex text. A task holds aligned blocks of FANOUT ** DEPTH nodes of one tree
as matrices of n x 64 bytes: reshaped by the fanout, each row is what a parent hashes, level by
level, and all siblings of a node are found by index arithmetic.

A tree higher than a block is made in rounds, the roots of blocks being the nodes of the next
one. On the way down, a block is given the path from its root to the root of all (the siblings at
each level), as a row of its own before its nodes. So no task holds more than a few blocks,
however many leaves a source has, and what is shuffled are digests, never texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .buckets import whole_groups
from .common import ascii_lower, cut

FANOUT = 16
DEPTH = 3
WIDTH = 64
TASK_ROWS = 16384
#: Siblings of so many nodes are gathered at a time.
GATHERED = 1024
#: The rows of every TAMPERED-th checksum of a decimal doc_id are tampered with.
TAMPERED = 5
FIELDS = ("doc_id", "source", "lang", "n_chars")

PATH = "siblings binary, places array<int>, sizes array<int>, subroot string, root string"
RESULT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def _leaf(text: Column) -> Column:
    return F.sha2(F.concat(*[_field(F.col(c)) for c in FIELDS], _field(text)).cast("binary"), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """Each row of ``docs``: doc_id, tree (its source; the null one sorts first), digest and tampered (null if it isn't)."""
    tree = F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("="), F.col("source").cast("string")))
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED == 0
    return docs.select(F.col("doc_id").cast("long"), tree.alias("tree"), _leaf(F.col("text")).alias("digest"), F.when(hit, _leaf(ascii_lower("text"))).alias("tampered"))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by tree (their first column), with the task's number and each row's place among the task's rows of its tree."""
    from pyspark import TaskContext

    part, last, seen = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        trees = batch.column(0).to_numpy(zero_copy_only=False)
        n = len(trees)
        if not n:
            continue
        number = np.arange(n)
        fresh = np.concatenate([[True], trees[1:] != trees[:-1]])
        begin = np.maximum.accumulate(np.where(fresh, number, 0))
        place = number - begin + np.where(begin == 0, seen if trees[0] == last else 0, 0)
        last, seen = trees[-1], int(place[-1]) + 1
        yield pa.record_batch([*batch.columns, pa.array(np.full(n, part, dtype=np.int64)), pa.array(place)], names=[*batch.schema.names, "part", "place"])


def ranked(nodes: DataFrame, *order: str) -> DataFrame:
    """``nodes`` (tree first) with ``rank``, from 0 on, and ``n`` of its tree; rows are sorted by range, so one tree may fill many tasks."""
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in nodes.schema.fields)
    by = ["tree", *order]
    placed = cut(nodes.repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(_counted, f"{ddl}, part long, place long"))
    own = Window.partitionBy("tree")  # a row for each task that has rows of the tree
    counts = placed.groupBy("tree", "part").agg(F.count("*").alias("here"))
    before = F.coalesce(F.sum("here").over(own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("tree", "part", before.alias("before"), F.sum("here").over(own).alias("n"))
    return placed.join(starts, ["tree", "part"]).select(*nodes.columns, (F.col("place") + F.col("before")).alias("rank"), "n")


def levels_of(digests: np.ndarray, n: int, depth: int) -> list[np.ndarray]:
    """The levels over ``digests`` (n x 64 bytes), themselves first: up to one node, or ``depth`` steps if the tree, of ``n`` nodes, has other blocks."""
    levels, whole = [digests], n > FANOUT**depth
    while len(levels) <= depth if whole else len(levels[-1]) > 1:
        now = levels[-1]
        full = len(now) // FANOUT
        rows = [*now[: full * FANOUT].reshape(full, FANOUT * WIDTH)]
        if len(now) % FANOUT:
            rows.append(now[full * FANOUT :].reshape(-1))
        levels.append(np.frombuffer("".join([_hex(r.data) for r in rows]).encode(), dtype=np.uint8).reshape(-1, WIDTH))
    return levels


def siblings_at(level: np.ndarray, nodes: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(the siblings of each node one after the other, its place in its run, the run's size)."""
    begin = nodes // FANOUT * FANOUT
    place, size = nodes - begin, np.minimum(len(level) - begin, FANOUT)
    out: list[bytes] = [b""] * len(nodes)
    for s in np.unique(size):
        at = np.flatnonzero(size == s)
        others = np.arange(s - 1)[None, :]
        gathered = level[begin[at, None] + others + (others >= place[at, None])]
        for i, row in zip(at.tolist(), gathered.reshape(len(at), -1)):
            out[i] = row.tobytes()
    return out, place, size


def fold(digest: str, siblings: bytes, places: list[int], sizes: list[int]) -> str:
    """The root that a digest and its siblings, level by level, lead to."""
    at = 0
    for place, size in zip(places, sizes):
        own, end = at + place * WIDTH, at + (size - 1) * WIDTH
        digest = _hex(siblings[at:own] + digest.encode() + siblings[own:end])
        at = end
    return digest


def _matrix(digests: pa.Array) -> np.ndarray:
    return np.frombuffer("".join(digests.to_pylist()).encode(), dtype=np.uint8).reshape(-1, WIDTH)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of one block each, of rows sorted by their first three columns: tree, block and rank."""
    for table in whole_groups(batches, 2, TASK_ROWS):
        tree, block = (table.column(i).to_numpy() for i in (0, 1))
        edges = np.flatnonzero(np.concatenate([[True], (tree[1:] != tree[:-1]) | (block[1:] != block[:-1]), [True]])).tolist()
        for start, end in zip(edges, edges[1:]):
            yield table.slice(start, end - start)


def _folding(depth: int):
    def fold_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The root of each block of nodes (tree, block, rank, n, digest), as a node of the next round."""
        for table in _blocks(batches):
            n = table.column(3)[0].as_py()
            top = levels_of(_matrix(table.column(4)), n, depth)[-1]
            row = {"tree": [table.column(0)[0].as_py()], "rank": [table.column(1)[0].as_py()], "n": [-(-n // FANOUT**depth)], "digest": [top.tobytes().decode()]}
            yield pa.RecordBatch.from_pydict(row, schema=pa.schema([("tree", pa.string()), ("rank", pa.int64()), ("n", pa.int64()), ("digest", pa.string())]))

    return fold_blocks


def _in_blocks(rows: DataFrame) -> DataFrame:
    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "rank")


def _rounds(nodes: DataFrame, depth: int) -> list[DataFrame]:
    """``nodes`` (tree, rank, n, digest) and the nodes of each round over them; the last are the roots."""
    rounds, most = [nodes], nodes.agg(F.max("n")).first()[0]
    while most > 1:
        own = rounds[-1].select("tree", F.expr(f"rank div {FANOUT**depth}").alias("block"), "rank", "n", "digest")
        rounds.append(cut(_in_blocks(own).mapInArrow(_folding(depth), "tree string, rank long, n long, digest string")))
        most = -(-most // FANOUT**depth)
    return rounds


def _paths(kind: str, depth: int):
    """What lies between each node of a block and the root of all, given the block's own path as its first row.

    ``kind``: 'leaf' gives the rows of the manifest, 'subroot' marks each node as the root of a source.
    """

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _blocks(batches):
            above = {c: table.column(c)[0].as_py() for c in ("siblings", "places", "sizes", "subroot", "root")}
            nodes = table.slice(1)
            digests = nodes.column("digest").to_pylist()
            levels = levels_of(_matrix(nodes.column("digest")), nodes.column("n")[0].as_py(), depth)[:-1]
            for begin in range(0, nodes.num_rows, GATHERED):
                at = np.arange(begin, min(begin + GATHERED, nodes.num_rows))
                steps = [siblings_at(level, at // FANOUT**k) for k, level in enumerate(levels)]
                joined = [b"".join([s[0][i] for s in steps]) + above["siblings"] for i in range(len(at))]
                places = [[int(s[1][i]) for s in steps] + above["places"] for i in range(len(at))]
                sizes = [[int(s[2][i]) for s in steps] + above["sizes"] for i in range(len(at))]
                part, own = nodes.slice(begin, len(at)).combine_chunks(), digests[begin : begin + len(at)]
                same = lambda value: pa.array([value] * len(at), pa.string())
                if kind == "leaf":
                    changed = part.column("tampered").to_pylist()
                    roots = [fold(t or d, s, p, z) for t, d, s, p, z in zip(changed, own, joined, places, sizes)]
                    columns = [part.column("doc_id"), part.column("digest"), same(above["subroot"]), same(above["root"]), pa.array([_hex(s) for s in joined]), pa.array(roots), pa.array([r == above["root"] for r in roots])]
                    yield pa.Table.from_arrays(columns, names=[c.split()[0] for c in RESULT.split(", ")]).combine_chunks().to_batches()[0]
                    continue
                columns = [part.column("down_tree"), part.column("down_block"), pa.array(joined, pa.binary()), *(pa.array(x, pa.list_(pa.int32())) for x in (places, sizes)), part.column("digest") if kind == "subroot" else same(above["subroot"]), same(above["root"])]
                yield pa.Table.from_arrays(columns, names=["tree", "block", "siblings", "places", "sizes", "subroot", "root"]).combine_chunks().to_batches()[0]

    return walk


def _down(nodes: DataFrame, paths: DataFrame, kind: str, depth: int) -> DataFrame:
    """The paths (or, of leaves, the manifest's rows) of ``nodes``, given those of their blocks."""
    own = nodes.withColumn("block", F.expr(f"rank div {FANOUT**depth}"))
    rows = paths.withColumn("rank", F.lit(-1).cast("long")).unionByName(own, allowMissingColumns=True)
    first = ["tree", "block", "rank"]
    rows = rows.select(*first, *[c for c in rows.columns if c not in first])
    return _in_blocks(rows).mapInArrow(_paths(kind, depth), RESULT if kind == "leaf" else f"tree string, block long, {PATH}")


def manifest(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of each row of ``docs``.

    Leaves are rows of the columns doc_id, source, lang, n_chars and text, nulls told from empty
    strings; others are not read. Rows without a doc_id come first in their source and aren't
    tampered with; rows that share one stand in the order of their digests, so equal rows are
    leaves of their own. A source of one leaf is its own subroot, a table of one source has its
    subroot as root, and a proof without siblings is the digest of nothing. An empty table gives
    an empty result. A block holds FANOUT ** ``depth`` nodes; the result does not depend on it.
    """
    spark = docs.sparkSession
    base = cut(ranked(cut(leaves(docs).select("tree", "doc_id", "digest", "tampered")), "doc_id", "digest"))
    if base.isEmpty():
        return spark.createDataFrame([], RESULT)
    trees = _rounds(base.select("tree", "rank", "n", "digest"), depth)
    roots = trees[-1].select(F.lit("").alias("tree"), F.col("tree").alias("down_tree"), "digest")
    sources = cut(ranked(roots, "down_tree")).withColumn("down_block", F.lit(0).cast("long"))
    above = _rounds(sources.select("tree", "rank", "n", "digest"), depth)
    paths = above[-1].select("tree", F.lit(0).cast("long").alias("block"), F.lit("").cast("binary").alias("siblings"), *[F.array().cast("array<int>").alias(c) for c in ("places", "sizes")], F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"))
    inner = lambda nodes: nodes.select("*", F.col("tree").alias("down_tree"), F.col("rank").alias("down_block"))
    for nodes in above[-2:0:-1]:
        paths = cut(_down(inner(nodes), paths, "inner", depth))
    paths = cut(_down(sources, paths, "subroot", depth))
    for nodes in trees[-2:0:-1]:
        paths = cut(_down(inner(nodes), paths, "inner", depth))
    return _down(base, paths, "leaf", depth)


def oracle() -> str:
    """DuckDB SQL for the rows of ``manifest``."""
    field = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR) END"
    leaf = lambda text: f"sha256({' || '.join(field(c) for c in (*FIELDS, text))})"
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    bits = "list_transform(range(9 * length(CAST(doc_id AS VARCHAR))), lambda i: CASE WHEN i % 9 = 0 THEN ascii(substr(CAST(doc_id AS VARCHAR), i // 9 + 1, 1)) ELSE -1 END)"
    crc = f"xor(4294967295, list_reduce(list_prepend(4294967295, {bits}), lambda x, e: CASE WHEN e >= 0 THEN xor(x, e) ELSE xor(x >> 1, (x & 1) * 3988292384) END))"
    step = f"sha256(string_agg(d, '' ORDER BY idx)), (any_value(n) + {FANOUT - 1}) // {FANOUT}"
    return f"""
WITH RECURSIVE hashed AS MATERIALIZED (
  SELECT doc_id, source, {leaf('text')} AS leaf, CASE WHEN {crc} % {TAMPERED} = 0 THEN {leaf(lowered)} END AS tampered FROM documents),
base AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY source) AS n,
         row_number() OVER () AS line FROM hashed),
trees AS (
  SELECT source, 0 AS lvl, idx, leaf AS d, n FROM base
  UNION ALL SELECT source, lvl + 1, idx // {FANOUT}, {step} FROM trees WHERE n > 1 GROUP BY source, lvl, idx // {FANOUT}),
subroots AS MATERIALIZED (
  SELECT source, d, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS idx, count(*) OVER () AS n, lvl FROM trees WHERE n = 1),
above AS (
  SELECT 0 AS lvl, idx, d, n FROM subroots
  UNION ALL SELECT lvl + 1, idx // {FANOUT}, {step} FROM above WHERE n > 1 GROUP BY lvl, idx // {FANOUT}),
nodes AS MATERIALIZED (
  SELECT source, false AS top, lvl, idx, d FROM trees WHERE n > 1
  UNION ALL SELECT NULL, true, lvl, idx, d FROM above WHERE n > 1),
walk AS (
  SELECT line, b.source, false AS top, 0 AS lvl, b.idx, coalesce(tampered, leaf) AS d, '' AS proof, b.n, s.idx AS own, s.n AS others FROM base b JOIN subroots s ON s.source IS NOT DISTINCT FROM b.source
  UNION ALL (
  SELECT line, any_value(w.source), w.top, w.lvl + 1, w.idx // {FANOUT}, sha256(string_agg(CASE WHEN v.idx = w.idx THEN w.d ELSE v.d END, '' ORDER BY v.idx)),
         any_value(w.proof) || coalesce(string_agg(CASE WHEN v.idx <> w.idx THEN v.d END, '' ORDER BY v.idx), ''), (any_value(w.n) + {FANOUT - 1}) // {FANOUT}, any_value(w.own), any_value(w.others)
  FROM walk w JOIN nodes v ON v.top = w.top AND (w.top OR v.source IS NOT DISTINCT FROM w.source) AND v.lvl = w.lvl AND v.idx // {FANOUT} = w.idx // {FANOUT} WHERE w.n > 1 GROUP BY line, w.top, w.lvl, w.idx
  UNION ALL SELECT line, source, true, 0, own, d, proof, others, own, others FROM walk WHERE n = 1 AND NOT top)),
ends AS (SELECT line, d, proof FROM walk WHERE top AND n = 1)
SELECT b.doc_id, b.leaf, s.d AS subroot, r.d AS root, sha256(e.proof) AS proof_sha256, e.d AS folded_root, e.d = r.d AS verified
FROM base b JOIN subroots s ON s.source IS NOT DISTINCT FROM b.source JOIN ends e USING (line), (SELECT d FROM above WHERE n = 1) r"""
