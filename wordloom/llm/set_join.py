"""Operator 11: similar documents by a Jaccard join of shingle sets, with PartEnum signatures.

Sets are put into bands of sizes such that similar ones stand in one band or in two neighbouring
ones; each set signs for its own band and for the next. In a band, similar sets differ in at most
k features, so if the domain of features is parted into n parts, they agree in n - k parts at
least. A signature is the content of a chosen subset of the parts: for a small k, all pairs of
k + 2 parts are enumerated; for a larger one, single parts, of which a few more than k + 1 are
made. Those spare parts allow a set to leave out as many of its nearly empty parts, which many
unlike sets have in common; a set with more of them than that signs with all. So no similar pair
is without a common signature.

Texts with the same words are one class. Classes with a common signature are linked to its least
one, within a task first, so that no more than a row of each task reaches the bucket of a
signature, however many texts have it. The components of these stars are candidates; in each,
intersections of all sets are counted exactly, and the links that hold make the result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .buckets import in_units, merge, whole_groups
from .common import cut
from .components import connected_components
from .simhash import among
from .substring_dedup import _mixed, class_of, in_slices, jaccard_distance, shingle_hashes

#: Sets are similar if OVER times their intersection is at least UNDER times their union.
OVER, UNDER = 100, 90
SHINGLE = 3
#: Up to this k, pairs of parts are enumerated; beyond it, single ones.
PAIRS_UP_TO = 3
#: A part with fewer features is nearly empty.
WEAK = 3
MET_ROWS = 2_000_000
BUCKET_ROWS = 1024
TASK_ROWS = 8192
#: Features of a unit that are counted at a time.
COLUMNS = 4096
_STEP = 0x9E3779B97F4A7C15


def bands(over: int = OVER, under: int = UNDER) -> Iterator[tuple[int, int, int]]:
    """(first size, last size, k) of each band, without end: similar sets, the larger in the band, differ in k features at most."""
    first = 1
    while True:
        last = first * over // under
        yield first, last, 2 * last * (over - under) // (over + under)
        first = last + 1


@lru_cache(maxsize=64)
def bands_up_to(size: int, over: int = OVER, under: int = UNDER) -> tuple[list[int], list[int]]:
    """(last size, k) of the bands from the first one to the one after that of ``size``."""
    lasts, most = [], []
    for _, last, k in bands(over, under):
        lasts.append(last)
        most.append(k)
        if len(lasts) > 1 and lasts[-2] >= size:
            return lasts, most


def parts_of(k: int) -> tuple[int, int]:
    """(parts, parts of a subset) for sets that differ in up to k features."""
    if k == 0:
        return 1, 1
    return (k + 2, 2) if k <= PAIRS_UP_TO else (k + 1 + spare(k), 1)


def spare(k: int) -> int:
    """Parts that a set may leave out because they are nearly empty."""
    return 2 + k // 8 if k > PAIRS_UP_TO else 0


@lru_cache(maxsize=4096)
def _subsets(k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(inner bounds of the parts in the domain of features, first part, second part of each subset; one part twice if it is alone)."""
    n, chosen = parts_of(k)
    bounds = np.array([(j << 64) // n for j in range(1, n)], dtype=np.uint64)
    pairs = np.array(list(combinations(range(n), 2)) if chosen == 2 else [(j, j) for j in range(n)]).T
    return bounds, pairs[0], pairs[1]


def signatures(features: np.ndarray, over: int = OVER, under: int = UNDER) -> np.ndarray:
    """The signatures of a set, given its features as sorted distinct 64-bit hashes; none for an empty set."""
    size = len(features)
    if not size:
        return np.zeros(0, dtype=np.uint64)
    lasts, most = bands_up_to(1 << (size - 1).bit_length(), over, under)
    band = int(np.searchsorted(lasts, size))
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(_mixed(features * np.uint64(_STEP)), dtype=np.uint64)])
    out = []
    for tag in (band, band + 1):
        k = most[tag]
        bounds, one, other = _subsets(k)
        # Features are spread evenly over their domain, and sorted, so that a part is a slice.
        edges = np.concatenate([[0], np.searchsorted(features, bounds), [size]])
        counts, content = np.diff(edges), sums[edges[1:]] - sums[edges[:-1]]
        key = content[one] + counts[one].astype(np.uint64)
        if len(other) and one[0] != other[0]:
            key = _mixed(key) + content[other] + counts[other].astype(np.uint64)
        key = _mixed(key + (np.arange(len(one), dtype=np.uint64) + np.uint64(tag << 32)) * np.uint64(_STEP))
        weak = counts < WEAK
        if spare(k) and weak.sum() <= spare(k):
            key = key[~weak]
        out.append(key)
    return np.concatenate(out)


def words_of(text: str | None) -> list[bytes]:
    """The words of a text, A-Z lower-cased: runs without ASCII white space."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def features_of(words: list[bytes]) -> np.ndarray:
    """The sorted distinct hashes of the shingles of words; fewer words than a shingle are one, none have none."""
    return np.unique(shingle_hashes(words, SHINGLE)) if words else np.zeros(0, dtype=np.uint64)


def _ended(sizes: list[int], values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), pa.int32()), pa.array(values.view(np.int64)))


def _signed(docs: DataFrame, over: int, under: int) -> DataFrame:
    """Each row of ``docs``: doc_id, mark (a hash of its text), class (128 bits of its words), n_shingles and its signatures."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            words = [words_of(x.as_py()) for x in batch.column(2)]
            sets = [features_of(w) for w in words]
            signed = [signatures(s, over, under) for s in sets]
            flat = np.concatenate(signed) if signed else np.zeros(0, dtype=np.uint64)
            columns = [batch.column(0), batch.column(1), pa.array([class_of(w) for w in words], pa.binary()), pa.array([len(s) for s in sets], pa.int64()), _ended([len(s) for s in signed], flat)]
            yield pa.record_batch(columns, names=["doc_id", "mark", "class", "n_shingles", "signatures"])

    marked = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("mark"), "text")
    return marked.mapInArrow(sign, "doc_id long, mark long, class binary, n_shingles long, signatures array<long>")


def _node(digest: Column) -> Column:
    """A class as 64 bits: enough to find candidates, as two classes with one node are only compared once more."""
    return F.xxhash64(digest)


def _stars(keys: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, its least node, a, b): the links a-b join the other nodes of a key to its least."""
    order = np.lexsort((nodes, keys))
    keys, nodes = keys[order], nodes[order]
    first = np.concatenate([[True], keys[1:] != keys[:-1]])
    least = nodes[np.maximum.accumulate(np.where(first, np.arange(len(keys)), 0))]
    apart = np.flatnonzero(nodes != least)
    links = np.unique(np.stack([least[apart], nodes[apart]], axis=1), axis=0)
    return keys[first], nodes[first], links[:, 0], links[:, 1]


def _gathered(met_rows: int):
    """Rows (node, signatures) of a task as rows (key, node), a row for each key; links within the task get a key of their own."""

    def flush(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        keys, least, a, b = _stars(np.concatenate([k for k, _ in held]), np.concatenate([n for _, n in held]))
        own = _mixed(_mixed(a.view(np.uint64)) + b.view(np.uint64)).view(np.int64)
        return pa.record_batch([pa.array(np.concatenate([keys, own, own])), pa.array(np.concatenate([least, a, b]))], names=["key", "node"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            lists = batch.column(1)
            flat = lists.flatten().to_numpy()
            held.append((flat, np.repeat(batch.column(0).to_numpy(), lists.value_lengths().to_numpy())))
            count += len(flat)
            if count >= met_rows:
                yield flush(held)
                held, count = [], 0
        if count:
            yield flush(held)

    return gather


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between the nodes of each key, of rows (key, node) sorted by both."""
    last: tuple[int, int] | None = None
    for batch in batches:
        keys, nodes = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if not len(keys):
            continue
        if last and keys[0] == last[0]:
            keys, nodes = np.concatenate([[last[0]], keys]), np.concatenate([[last[1]], nodes])
        own, least, a, b = _stars(keys, nodes)
        last = (int(own[-1]), int(least[-1]))
        yield pa.record_batch([pa.array(a), pa.array(b)], names=["a", "b"])


def candidates(signed: DataFrame, met_rows: int = MET_ROWS) -> DataFrame:
    """(node, component) of the nodes that share signatures with others, from rows (node, signatures)."""
    met = signed.mapInArrow(_gathered(met_rows), "key long, node long")
    links = met.repartition("key").sortWithinPartitions("key", "node").mapInArrow(_linked, "a long, b long")
    return connected_components(links)


def similar_pairs(sets: list[np.ndarray], over: int = OVER, under: int = UNDER) -> tuple[np.ndarray, np.ndarray]:
    """Links that join all of the sets within reach of each other, by counting the intersections of all of them.

    Only features of several sets count; COLUMNS of them at a time are a matrix of sets and features.
    """
    sizes = np.array([len(s) for s in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), sizes)
    several = times > 1
    number = np.cumsum(several) - 1
    kept = several[column]
    row, column = row[kept], number[column[kept]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    shared = np.zeros((len(sets), len(sets)), dtype=np.float32)
    for begin in range(0, int(number[-1]) + 1 if len(number) else 0, COLUMNS):
        start, end = np.searchsorted(column, [begin, begin + COLUMNS])
        part = np.zeros((len(sets), min(COLUMNS, int(number[-1]) + 1 - begin)), dtype=np.float32)
        part[row[start:end], column[start:end] - begin] = 1
        shared += part @ part.T  # sums of ones below 2**24 are exact
    both = np.rint(shared).astype(np.int64)
    union = sizes[:, None] + sizes[None, :] - both
    a, b = np.nonzero(np.triu(over * both >= under * union, 1))
    label = merge(np.arange(len(sets)), a, b)
    moved = np.flatnonzero(label != np.arange(len(sets)))
    return label[moved], moved


def _verified(over: int, under: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, 2, TASK_ROWS):
            key, unit, node = table.column(0).to_numpy(), table.column(1).to_numpy(), table.column(2).to_pylist()
            shingles = table.column(3).combine_chunks()
            flat, cuts = shingles.values.to_numpy(), shingles.offsets.to_numpy()
            edges = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (unit[1:] != unit[:-1]), [True]])).tolist()
            a, b = [], []
            for s, e in zip(edges, edges[1:]):
                if e - s > 1:
                    one, other = similar_pairs([flat[cuts[i] : cuts[i + 1]] for i in range(s, e)], over, under)
                    a += [node[s + i] for i in one.tolist()]
                    b += [node[s + i] for i in other.tolist()]
            yield pa.record_batch([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    return verify


def _sets(texts: DataFrame) -> DataFrame:
    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            words = [words_of(x.as_py()) for x in batch.column(0)]
            sets = [features_of(w) for w in words]
            flat = np.concatenate(sets) if sets else np.zeros(0, dtype=np.uint64)
            yield pa.record_batch([pa.array([class_of(w) for w in words], pa.binary()), _ended([len(s) for s in sets], flat)], names=["class", "shingles"])

    return texts.mapInArrow(shingle, "class binary, shingles array<long>")


def linked_classes(docs: DataFrame, signed: DataFrame, over: int = OVER, under: int = UNDER, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(class, component) of the classes that are linked to others; a component is its least class."""
    nodes = signed.where("n_shingles > 0").select(_node(F.col("class")).alias("node"), "signatures")
    found = candidates(nodes).select("node", F.col("component").alias("key"))
    order = F.struct("doc_id", "mark")
    met = cut(signed.select(_node(F.col("class")).alias("node"), "class", "doc_id", "mark").join(found, "node").groupBy("class", "key").agg(F.min(order).alias("first")))
    texts = among(docs, cut(met.select("first.doc_id", "first.mark")), "left_semi")
    sets = cut(_sets(texts.select("text"))).dropDuplicates(["class"])

    rows = met.select("key", "class").join(sets, "class").select("key", "class", "shingles")
    units, linked = in_units(rows, "key", "class", bucket_rows, met, "shingles", jaccard_distance, round(1 - under / over, 12))
    links = units.select("key", "unit", "class", "shingles").repartition("key", "unit").sortWithinPartitions("key", "unit", "class").mapInArrow(_verified(over, under), "a binary, b binary")
    return connected_components(links if linked is None else links.union(linked)).withColumnRenamed("node", "class")


def similar_documents(docs: DataFrame, over: int = OVER, under: int = UNDER) -> DataFrame:
    """doc_id, n_shingles and component_id of each row of ``docs`` (doc_id, text).

    Two rows are linked if ``over`` times the size of the intersection of their shingle sets is at
    least ``under`` times that of the union; the component is the smallest doc_id within reach.
    Null and empty texts and those of white space have no shingles and are linked with nothing.
    Rows that repeat a doc_id, or have none, are rows of their own; a component without any doc_id
    has a null id. Other columns are not read; an empty table gives an empty result.
    """
    docs = docs.select("doc_id", "text")
    signed = cut(_signed(docs, over, under))
    classes = signed.where("n_shingles > 0").groupBy("class").agg(F.min("doc_id").alias("least"))
    linked = linked_classes(docs, signed, over, under)
    rooted = cut(classes.join(linked, "class", "left").select("class", "least", F.coalesce("component", "class").alias("root")))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("class", "component_id")
    whole = signed.where("n_shingles > 0").join(named, "class").select("doc_id", "n_shingles", "component_id")
    return whole.unionByName(signed.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def oracle() -> str:
    """DuckDB SQL for the rows of ``similar_documents``, by the intersections of all pairs that share a shingle."""
    lowered = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH RECURSIVE told AS (SELECT row_number() OVER () AS line, doc_id, regexp_extract_all({lowered}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS MATERIALIZED (
  SELECT line, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {SHINGLE} THEN [list_aggregate(w, 'string_agg', ' ')]
         ELSE list_distinct(list_transform(range(1, len(w) - {SHINGLE - 2}), lambda i: list_aggregate(w[i:i + {SHINGLE - 1}], 'string_agg', ' '))) END AS s FROM told),
flat AS MATERIALIZED (SELECT line, n, hash(s) AS s FROM (SELECT line, len(s) AS n, unnest(s) AS s FROM sets)),
links AS MATERIALIZED (
  SELECT a.line AS a, b.line AS b FROM flat a JOIN flat b ON a.s = b.s AND a.line < b.line AND {UNDER} * a.n <= {OVER} * b.n AND {UNDER} * b.n <= {OVER} * a.n
  GROUP BY a.line, b.line, a.n, b.n HAVING {OVER} * count(*) >= {UNDER} * (a.n + b.n - count(*))),
edges AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT line, line AS other FROM sets UNION SELECT r.line, e.b FROM reach r JOIN edges e ON e.a = r.other)
SELECT any_value(s.doc_id) AS doc_id, any_value(len(s.s)) AS n_shingles, min(o.doc_id) AS component_id
FROM reach r JOIN sets s USING (line) JOIN sets o ON o.line = r.other GROUP BY r.line"""
