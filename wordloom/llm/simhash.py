"""Operator 9: near duplicates by SimHash, found with pivot distance tables.

Equal fingerprints are one class. Two fingerprints that differ in at most ``max_bits`` bits
agree on all bits of some blocks, so classes meet in buckets of such blocks. In a bucket, the
Hamming distances of each fingerprint to many reference fingerprints (pivots) are computed
once: by the triangle inequality, a pair whose distances to any pivot differ by more than
``max_bits`` is no link. The rows are ordered by their distance to the first pivot, which ends
the scan of each row early; the other pivots discard most pairs that are left, and the rest
are verified bit by bit. Pairs that are already linked are passed over, and only the links
that join two groups leave the task, so a bucket yields fewer links than it has rows.

Documents that are alike by word shingles (Jaccard of 0.8 or more) differ in far more bits than
blocks or samples of bits can cover. They meet in buckets of MinHash bands, whose recall depends
on the similarity alone, wherever the texts differ. There, wide fingerprints (256 bits, of the
distinct shingles) and a limit far above the distance that the similarity allows give tentative
groups; and inside those, exact Jaccard similarities decide.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .buckets import in_units, merge, whole_groups
from .common import cut, small, unused
from .components import connected_components
from .substring_dedup import _mixed, class_of, in_slices, shingle_hashes, tune_bands, verified_links

SEED = 42
PIVOTS = 16
BUCKET_ROWS = 4096
#: Blocks are added until a bucket has about this many classes on average.
MEAN_BUCKET = 64
TASK_ROWS = 200_000
#: Wide fingerprints: 64-bit words, and the share of bits in which near copies may differ. Sets of
#: shingles with a Jaccard similarity of 0.8 differ in 15 % of the bits on average (19 % if they are
#: very small), with a deviation of 2.5 %; strangers in 50 %.
WIDE = 4
WIDE_LIMIT = 0.28
#: Recall of the buckets for a pair that is just similar enough.
RECALL = 0.9999
MAX_BANDS = 24
SIMILARITY = 0.8
SIMILAR_SHINGLE = 5


def pivots(n: int = PIVOTS) -> np.ndarray:
    """Reference fingerprints: hashes of the numbers from 0 on."""
    import xxhash

    return np.array([xxhash.xxh64_intdigest(i.to_bytes(8, "little"), SEED) for i in range(n)], dtype=np.uint64)


def fingerprint(text: str | None, shingle: int) -> int:
    """SimHash of a text's word shingles, as an unsigned integer; 0 for a text without words.

    A-Z are lower-cased; words are runs without ASCII white space. A text with fewer words than
    a shingle is one shingle. A bit is set if it is set in over half of the shingles' hashes.
    """
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = len(words) - shingle + 1
    if n <= 1:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[: n - 1] + 1]).tolist()
    digest, seed = xxhash.xxh64_intdigest, SEED
    hashes = np.array([digest(joined[s:e], seed) for s, e in zip(starts, ends[shingle - 1 :].tolist())], dtype=np.uint64)
    bytes_ = hashes.astype(">u8").view(np.uint8).reshape(-1, 8)
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 1 << 15):
        counts += np.unpackbits(bytes_[at : at + (1 << 15)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def with_fingerprint(docs: DataFrame, shingle: int = 3, name: str = "fp") -> DataFrame:
    """``docs`` and its fingerprint as a signed 64-bit column."""
    at = docs.columns.index("text")
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(x.as_py(), shingle) for x in batch.column(at)], dtype=np.uint64).view(np.int64)
            yield pa.record_batch([*batch.columns, pa.array(fps)], names=[*batch.schema.names, name])

    return docs.mapInArrow(add, schema)


def masks(max_bits: int, blocks: int) -> list[int]:
    """Bit masks such that two values within ``max_bits`` bits agree under at least one of them."""
    edges = [64 * b // blocks for b in range(blocks + 1)]
    parts = [((1 << edges[b + 1]) - 1) ^ ((1 << edges[b]) - 1) for b in range(blocks)]
    return [sum(chosen) for chosen in combinations(parts, blocks - max_bits)]


def blocks_for(n: int, max_bits: int) -> int:
    """Blocks for ``n`` classes: the more classes, the more bits a bucket must agree on."""
    blocks = max_bits + 1
    while n >> (64 * (blocks - max_bits) // blocks) > MEAN_BUCKET and blocks < max_bits + 5:
        blocks += 1
    return blocks


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _linker(max_bits: int, width: int = 1):
    """Links between fingerprints of ``width`` 64-bit words, given as (key, unit, near, fp) sorted by the first three."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        references = pivots(PIVOTS * width).reshape(PIVOTS, width)
        for table in whole_groups(batches, 2, TASK_ROWS):
            key, unit, near = (c.to_numpy() for c in table.columns[:3])
            n = len(key)
            group = np.cumsum(np.concatenate([[0], (key[1:] != key[:-1]) | (unit[1:] != unit[:-1])]))
            coded = pc.dictionary_encode(table.column(3).combine_chunks())
            # By value, so that a group has the same first member in each bucket in which all of it meets.
            order = pc.sort_indices(coded.dictionary)
            rank = np.empty(len(order), dtype=np.int64)
            rank[order.to_numpy()] = np.arange(len(order))
            nodes, at = coded.dictionary.take(order), rank[coded.indices.to_numpy()]
            raw = nodes.to_numpy(zero_copy_only=False) if width == 1 else np.frombuffer(b"".join(nodes.to_pylist()), dtype="<u8")
            bits = raw.view(np.uint64).reshape(-1, width)[at]
            distances = [np.bitwise_count(bits ^ r).sum(axis=1, dtype=np.int16) for r in references]
            label = np.arange(len(nodes))
            a, lag = np.arange(n - 1), 1
            while True:
                a = a[a + lag < n]
                a = a[(group[a + lag] == group[a]) & (near[a + lag] - near[a] <= max_bits)]
                if not len(a):
                    break
                left = a[label[at[a]] != label[at[a + lag]]]
                for d in distances[1:]:
                    if not len(left):
                        break
                    left = left[np.abs(d[left] - d[left + lag]) <= max_bits]
                left = left[np.bitwise_count(bits[left] ^ bits[left + lag]).sum(axis=1, dtype=np.int16) <= max_bits]
                label = merge(label, at[left], at[left + lag])
                lag += 1
            moved = np.flatnonzero(label != np.arange(len(nodes)))
            yield pa.record_batch([nodes.take(pa.array(moved)), nodes.take(pa.array(label[moved]))], names=["a", "b"])

    return link


def links(classes: DataFrame, max_bits: int = 3, blocks: int | None = None, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Links (a, b) between the distinct fingerprints in column fp; they connect whatever is within reach of each other."""
    if blocks is None:
        blocks = blocks_for(classes.count(), max_bits)
    near = F.bit_count(F.col("fp").bitwiseXOR(F.lit(_signed(int(pivots(1)[0]))))).cast("int")
    keys = [F.xxhash64(F.lit(t), F.col("fp").bitwiseAND(F.lit(_signed(m)))) for t, m in enumerate(masks(max_bits, blocks))]
    rows = classes.select(F.explode(F.array(*keys)).alias("key"), near.alias("near"), "fp")
    rows = rows.withColumn("bits", F.col("fp"))
    units, linked = in_units(rows, "key", "fp", bucket_rows, payload="bits", distance=lambda x, y: F.bit_count(x.bitwiseXOR(y)), reach=max_bits)
    met = units.select("key", "unit", "near", "fp").repartition("key", "unit").sortWithinPartitions("key", "unit", "near").mapInArrow(_linker(max_bits), "a long, b long")
    return met if linked is None else met.union(linked)


def class_components(fps: DataFrame, max_bits: int = 3) -> DataFrame:
    """(fp, root) for each distinct fingerprint in ``fps``; linked ones have one root."""
    classes = cut(fps.select("fp").distinct())
    found = connected_components(links(classes, max_bits))
    return classes.join(found.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("component", "fp").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """doc_id, fingerprint and component_id of each row of ``docs`` (doc_id, text).

    The component is the smallest doc_id within reach over links of at most ``max_bits`` bits.
    Null and empty texts have fingerprint zero and are linked like any other. Rows that repeat a
    doc_id, or have none, are rows of their own; a component without any doc_id has a null id.
    Other columns are not read; an empty table gives an empty result.
    """
    fps = cut(with_fingerprint(docs.select(F.col("doc_id").cast("long"), "text"), shingle).select("doc_id", "fp"))
    classes = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    rooted = cut(class_components(fps, max_bits).join(classes, "fp"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id")
    text = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return fps.join(named, "fp").select("doc_id", text, "component_id")


# Wide fingerprints and shingle similarity


def wide_fingerprint(shingles: np.ndarray, width: int = WIDE) -> bytes:
    """SimHash of distinct shingle hashes, ``width`` words of 64 bits."""
    counts = np.zeros(64 * width, dtype=np.int64)
    for at in range(0, len(shingles), 1 << 14):
        part = shingles[at : at + (1 << 14)]
        own = np.stack([_mixed(part + r) for r in pivots(width)], axis=1)
        bits = np.unpackbits(own.view(np.uint8), axis=1)
        counts += np.add.reduceat(bits, np.arange(0, len(bits), 255), axis=0, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * counts > len(shingles)).tobytes()


def band_keys(sets: list[np.ndarray], bands: int, rows: int) -> np.ndarray:
    """MinHash band keys of sets of shingle hashes, none of them empty: a row for each set."""
    keys = np.zeros((len(sets), bands), dtype=np.uint64)
    if sets:
        flat = np.concatenate(sets)
        starts = np.cumsum([0, *map(len, sets)])[:-1]
        factors = pivots(bands * rows) | np.uint64(1)
        for b in range(bands):
            key = np.full(len(sets), b, dtype=np.uint64)
            for factor in factors[b * rows : (b + 1) * rows]:
                key = _mixed(key * np.uint64(3) + np.minimum.reduceat(_mixed(flat * factor), starts))
            keys[:, b] = key
    return keys


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def _shingles(words: list[bytes]) -> np.ndarray:
    """The distinct hashes of a text's shingles; a text without words has one of its own."""
    return np.unique(shingle_hashes(words or [b""], SIMILAR_SHINGLE))


def _signed_texts(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """Each text: doc_id, mark (a hash of it), class (128 bits of its lower-cased words), fp (wide), near (distance to the first pivot) and its band keys."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = pivots(WIDE)
        for batch in in_slices(batches):
            words = [_words(x.as_py()) for x in batch.column(2)]
            sets = [_shingles(w) for w in words]
            fps = [wide_fingerprint(s) for s in sets]
            near = np.bitwise_count(np.frombuffer(b"".join(fps), dtype="<u8").reshape(-1, WIDE) ^ first).sum(axis=1, dtype=np.int32)
            keys = band_keys(sets, bands, rows)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, bands, dtype=np.int32)), pa.array(keys.ravel().view(np.int64)))
            columns = [batch.column(0), batch.column(1), pa.array([class_of(w) for w in words], pa.binary()), pa.array(fps, pa.binary()), pa.array(near), lists]
            yield pa.record_batch(columns, names=["doc_id", "mark", "class", "fp", "near", "bands"])

    marked = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("mark"), "text")
    return marked.mapInArrow(sign, "doc_id long, mark long, class binary, fp binary, near int, bands array<long>")


def _words_apart(x: Column, y: Column) -> Column:
    """Bits in which two fingerprints differ, given as their 64-bit words."""
    return sum((F.bit_count(F.get(x, F.lit(k)).bitwiseXOR(F.get(y, F.lit(k)))) for k in range(WIDE)), F.lit(0))


def wide_links(classes: DataFrame, max_bits: int, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Links between distinct wide fingerprints (fp, near, bands) that share a band and differ in ``max_bits`` at most."""
    keyed = classes.select(F.explode("bands").alias("key"), "near", "fp")
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")  # most bands are one text's alone
    rows = cut(keyed.join(shared, "key"))
    words = F.transform(F.sequence(F.lit(0), F.lit(WIDE - 1)), lambda k: F.conv(F.hex(F.substring("fp", k * 8 + 1, 8)), 16, -10).cast("long"))
    units, linked = in_units(rows.withColumn("words", words), "key", "fp", bucket_rows, payload="words", distance=_words_apart, reach=max_bits)
    met = units.select("key", "unit", "near", "fp").repartition("key", "unit").sortWithinPartitions("key", "unit", "near").mapInArrow(_linker(max_bits, WIDE), "a binary, b binary")
    return met if linked is None else met.union(linked)


def _shingle_sets(texts: DataFrame) -> DataFrame:
    """(class, distinct shingle hashes) of rows (text)."""

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            words = [_words(x.as_py()) for x in batch.column(0)]
            sets = [_shingles(w).view(np.int64) for w in words]
            yield pa.record_batch([pa.array([class_of(w) for w in words], pa.binary()), pa.array(sets, pa.list_(pa.int64()))], names=["class", "shingles"])

    return texts.mapInArrow(shingle, "class binary, shingles array<long>")


def among(docs: DataFrame, rows: DataFrame, how: str) -> DataFrame:
    """The rows of ``docs`` that are (``left_semi``) or are not (``left_anti``) in the written table ``rows`` (doc_id, mark).

    The texts of ``docs`` are shuffled only if ``rows`` is too large to be broadcast.
    """
    doc, mark = unused(docs.columns, "_doc"), unused(docs.columns, "_mark")
    named = small(rows.select(F.col("doc_id").alias(doc), F.col("mark").alias(mark)))
    return docs.join(named, docs["doc_id"].cast("long").eqNullSafe(F.col(doc)) & (F.xxhash64(docs["text"]) == F.col(mark)), how)


def similar_classes(docs: DataFrame, similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """(classes, rows). Classes: class, root and first of each distinct text, its cluster by shingle similarity and its first row.

    ``first`` orders rows by doc_id (none comes last) within the class. Rows: doc_id, mark (a
    hash of the text) and class of each row of ``docs``.
    """
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")
    signed = cut(_signed_texts(docs, *tune_bands(similarity, RECALL, MAX_BANDS)))
    # The bands and fingerprint are the class's own, so any row's will do.
    firsts = cut(signed.groupBy("class").agg(F.min(order).alias("first")))
    where = firsts.select("class", F.col("first.doc_id").alias("id"), F.col("first.mark").alias("own"))
    alike = (signed["class"] == where["class"]) & signed["doc_id"].eqNullSafe(where["id"]) & (signed["mark"] == where["own"])
    classes = signed.join(where, alike, "left_semi").select("class", "fp", "near", "bands")
    near = connected_components(wide_links(classes, int(64 * WIDE * WIDE_LIMIT)))
    fps = signed.groupBy("class").agg(F.min("fp").alias("fp"))
    grouped = fps.join(near.withColumnRenamed("node", "fp"), "fp", "left").select("class", F.coalesce("component", "fp").alias("key"))
    several = grouped.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    met = cut(grouped.join(several, "key").select("key", "class"))
    wanted = cut(firsts.join(met, "class", "left_semi").select("first.doc_id", "first.mark"))
    sets = cut(_shingle_sets(among(docs.select("doc_id", "text"), wanted, "left_semi").select("text"))).dropDuplicates(["class"])
    linked = connected_components(verified_links(met.join(sets, "class").select("key", "class", "shingles"), similarity, met)).withColumnRenamed("node", "class")
    told = firsts.join(linked, "class", "left").select("class", F.coalesce("component", "class").alias("root"), "first")
    return told, signed.select("doc_id", "mark", "class")


def keep_first(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row of each cluster of near duplicates in ``docs``, with its columns as they were.

    Texts with the same words are duplicates, empty and null ones included; others are linked
    by the Jaccard similarity of their shingles of five words. The row with the smallest doc_id
    stays; null ids come last, and of rows alike in doc_id and words one stays.
    """
    classes, rows = similar_classes(docs.select("doc_id", "text"), similarity)
    classes = cut(classes)
    chosen = classes.groupBy("root").agg(F.min(F.struct("first", "class")).alias("least"))
    kept = chosen.select("least.first.doc_id", "least.first.mark")
    id_, own = F.col("doc_id"), F.col("mark")
    counted = rows.groupBy("doc_id", "mark").agg(F.count("*").alias("n"))
    told = counted.join(kept.select(id_.alias("id"), own.alias("own"), F.lit(True).alias("kept")), id_.eqNullSafe(F.col("id")) & (own == F.col("own")), "left")
    gone = cut(told.where("kept IS NULL").select("doc_id", "mark"))
    left = among(docs, gone, "left_anti")
    again = cut(told.where("kept AND n > 1").select("doc_id", "mark"))
    if again.isEmpty():
        return left
    # Rows alike in doc_id and text: one of them stays.
    key = unused(docs.columns, "_key")
    one = among(left, again, "left_semi").withColumn(key, F.xxhash64("text")).dropDuplicates(["doc_id", key]).drop(key)
    return among(left, again, "left_anti").unionByName(one)
