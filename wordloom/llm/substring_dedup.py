"""Operator 2: repeated paragraphs, by MinHash banding over paragraphs.

Paragraphs are the lines of a text that have a word. Equal ones (after ASCII lower-casing and with
single blanks) are one class; lines with fewer words than a shingle are only compared as equal or
not. Other classes whose MinHash signatures agree in
a band meet in a bucket; there, exact Jaccard similarities of their word shingles decide, and
short of a link that joins two groups nothing leaves the task. Connected components of the
links are the clusters; all but the first paragraph of a cluster are removed.

Passages that repeat across documents without regard to lines are found by windows of WINDOW
words. Which windows of a text stand for it depends on their own words only (the least hash of a
stretch), so any run of REACH words that two documents share has one of them in common. Those
that repeat are seeds, and a run of words from a seed to the next one that repeats as a whole
needs no closer look. Around the seeds where no such run is, all windows are hashed and counted;
runs and windows that repeat are joined up to passages, from the first word to the last.

A text is read twice: once for its paragraphs and chosen windows, which are written as a table,
and once more, only where it has something that repeats, for shingles and windows around seeds.
"""

from __future__ import annotations

import math
import re
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .buckets import in_units, whole_groups
from .common import cut, tidy, unused
from .components import connected_components
from .merkle import ranked

MIN_WORDS = 1
WINDOW = 20
SHINGLE = 5
SIMILARITY = 0.8
RECALL = 0.99
MAX_BANDS = 8
BUCKET_ROWS = 1024
TASK_ROWS = 20_000
SLICE_ROWS = 128
SEED = 42
#: A run of so many words that two documents share is always found whole, wherever it stands.
REACH = 50
_FACTOR = 0x9E3779B97F4A7C15
#: Stands for "no doc_id" where the least id of several rows is sought.
NO_ID = (1 << 63) - 1
_WORD = re.compile(r"[^\x20\x09-\x0d]+")


def tune_bands(similarity: float = SIMILARITY, recall: float = RECALL, max_bands: int = MAX_BANDS) -> tuple[int, int]:
    """(bands, rows): the most rows a band for which a pair at the similarity meets with the recall."""
    best = (1, 1)
    for rows in range(1, 17):
        hit = similarity**rows
        bands = math.ceil(math.log(1 - recall) / math.log(1 - hit)) if hit < 1 else 1
        if bands <= max_bands:
            best = (bands, rows)
    return best


def word_hashes(words: list[bytes]) -> np.ndarray:
    import xxhash

    digest = xxhash.xxh3_64_intdigest
    return np.array([digest(w, SEED) for w in words], dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads their bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles_of(h: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Hashes of all runs of ``size`` words, given by their hashes, in order; fewer words are one shingle."""
    n = max(len(h) - size + 1, 1)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(min(size, len(h))):
        out = _mixed(out * np.uint64(3) + h[k : k + n])
    return out


def shingle_hashes(words: list[bytes], size: int = SHINGLE) -> np.ndarray:
    return shingles_of(word_hashes(words), size)


def paragraphs(text: str | None, least: int = MIN_WORDS) -> Iterator[tuple[int, int, int, list[bytes]]]:
    """(number, start, length in code points, lower-cased words) of each line with enough words."""
    at = 0
    for number, line in enumerate((text or "").split("\n")):
        words = line.encode("utf-8", "surrogatepass").lower().split()
        if len(words) >= least:
            yield number, at, len(line), words
        at += len(line) + 1


def class_of(words: list[bytes]) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(b" ".join(words), SEED)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def in_slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in parts so small that the arrays made of one stay in the processor's cache."""
    for batch in tidy(batches):
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def band_keys(h: np.ndarray, sizes: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """MinHash band keys of paragraphs of ``sizes`` words, SHINGLE or more, whose word hashes are ``h``."""
    import xxhash

    keys = np.zeros((len(sizes), bands), dtype=np.uint64)
    if not len(sizes):
        return keys
    factors = np.array([xxhash.xxh3_64_intdigest(i.to_bytes(4, "little"), SEED) | 1 for i in range(bands * rows)], dtype=np.uint64)
    # Shingles of all these paragraphs at once, but those over two of them.
    of = np.repeat(np.arange(len(sizes)), sizes)
    flat = shingles_of(h)[of[: 1 - SHINGLE] == of[SHINGLE - 1 :]]
    starts = np.cumsum(sizes) - sizes - (SHINGLE - 1) * np.arange(len(sizes))
    for b in range(bands):
        key = np.full(len(sizes), b, dtype=np.uint64)
        for factor in factors[b * rows : (b + 1) * rows]:
            key = _mixed(key * np.uint64(3) + np.minimum.reduceat(_mixed(flat * factor), starts))
        keys[:, b] = key
    return keys


SCAN_DDL = "doc_id long, row long, top int, numbers array<int>, starts array<int>, lengths array<int>, sizes array<int>, classes array<binary>, bands array<array<long>>, keys array<long>, firsts array<int>, gaps array<int>, runs array<long>"


def _lists(ends: np.ndarray, values: pa.Array) -> pa.Array:
    """``values`` as lists that end at ``ends``."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), values)


def named_rows(docs: DataFrame) -> DataFrame:
    """``docs`` as doc_id, row (a hash of doc_id and text, which tells rows apart) and text."""
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64(F.col("doc_id").cast("long"), "text").alias("row"), "text")


def scanned(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """Each row's paragraphs and chosen windows, from one reading of its text.

    Paragraphs: numbers, starts, lengths (code points), sizes (words), classes (128 bits) and bands
    (none if it has fewer words than a shingle). Windows: keys, firsts (word, from 0), gaps (words
    to the next chosen window, 0 for the last) and runs (hash of all words up to the end of that one).
    ``top`` is the last window's first word.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_slices(batches):
            numbers, starts, lengths, sizes, classes, ends, flat = [], [], [], [], [], [], []
            for text in part.column(2):
                for number, start, length, words in paragraphs(text.as_py()):
                    numbers.append(number)
                    starts.append(start)
                    lengths.append(length)
                    sizes.append(len(words))
                    classes.append(class_of(words))
                    flat += words
                ends.append(len(numbers))
            h, ends, own = word_hashes(flat), np.array(ends, dtype=np.int64), np.array(sizes, dtype=np.int64)
            whole = own >= SHINGLE
            keys = band_keys(h[np.repeat(whole, own)], own[whole], bands, rows)
            banded = _lists(np.cumsum(whole * bands), _signed(keys.ravel()))
            stops = np.concatenate([[0], np.cumsum(own)])[ends]  # in words
            begins = np.concatenate([[0], stops[:-1]])
            places, hashes = chosen_windows(h, stops - begins)
            text_of = np.searchsorted(stops, places, side="right")
            gaps = np.zeros(len(places), dtype=np.int64)
            if len(places) > 1:
                gaps[:-1] = np.where(text_of[1:] == text_of[:-1], np.diff(places), 0)
            runs = span_hashes(h, places, places + gaps + WINDOW)
            held = np.cumsum(np.bincount(text_of, minlength=len(ends)))
            columns = [part.column(0), part.column(1), pa.array((stops - begins - WINDOW).astype(np.int32))]
            columns += [_lists(ends, pa.array(x, t)) for x, t in ((numbers, pa.int32()), (starts, pa.int32()), (lengths, pa.int32()), (sizes, pa.int32()), (classes, pa.binary()))]
            columns += [_lists(ends, banded), _lists(held, _signed(hashes)), _lists(held, pa.array((places - begins[text_of]).astype(np.int32))), _lists(held, pa.array(gaps.astype(np.int32))), _lists(held, _signed(runs))]
            yield pa.record_batch(columns, names=[x.split()[0] for x in SCAN_DDL.split(", ")])

    return named_rows(docs).mapInArrow(scan, SCAN_DDL)


def _sliding(values: np.ndarray, width: int, least: bool) -> np.ndarray:
    """The least (or greatest) of each ``width`` values in a row."""
    pick, out, have = np.minimum if least else np.maximum, values, 1
    while 2 * have <= width:
        out, have = pick(out[:-have], out[have:]), 2 * have
    return pick(out[: len(values) - width + 1], out[width - have :]) if have < width else out


def span_hashes(h: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Hashes of the runs of word hashes from ``starts`` to ``stops``, each from the words alone, by prefix sums modulo 2**64."""
    powers = np.cumprod(np.full(len(h), np.uint64(_FACTOR), dtype=np.uint64))
    back = np.cumprod(np.full(len(h), np.uint64(pow(_FACTOR, -1, 1 << 64)), dtype=np.uint64))
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(h * powers, dtype=np.uint64)])
    return _mixed((sums[stops] - sums[starts]) * back[starts] + (stops - starts).astype(np.uint64))


def window_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` word hashes."""
    starts = np.arange(len(h) - size + 1)
    return span_hashes(h, starts, starts + size)


def chosen_windows(h: np.ndarray, lengths: np.ndarray, size: int = WINDOW, reach: int = REACH) -> tuple[np.ndarray, np.ndarray]:
    """(start in ``h``, hash) of the windows that stand for texts of ``lengths`` words, whose word hashes are ``h``.

    Of each ``reach`` words in a row the window with the least hash is chosen; of equal ones
    that follow each other, one in ``size``, so that they touch.
    """
    if len(h) < reach:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    hashes, width = window_hashes(h, size), reach - size + 1
    text = np.repeat(np.arange(len(lengths)), lengths)
    least = _sliding(hashes, width, True)
    least[text[: len(least)] != text[reach - 1 :]] = 0  # a stretch over two texts chooses nothing
    edge = np.zeros(width - 1, dtype=np.uint64)
    chosen = _sliding(np.concatenate([edge, least, edge]), width, False) == hashes
    number, fresh = np.arange(len(hashes)), np.ones(len(hashes), dtype=bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (text[1 : len(hashes)] != text[: len(hashes) - 1])
    chosen &= (number - np.maximum.accumulate(np.where(fresh, number, 0))) % size == 0
    at = np.flatnonzero(chosen)
    return at, hashes[at]


def _several(rows: DataFrame, key: str) -> DataFrame:
    """(key, at, n) of the keys that two documents have: the first of them, and how often it stands."""
    seen = rows.groupBy(key).agg(F.min("doc").alias("at"), F.max("doc").alias("last"), F.count("*").alias("n"))
    # Written before it is joined, so that Spark can split the rows of a key that very many documents have.
    return cut(seen.where("at <> last").select(key, "at", "n"))


def told_apart(scan: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``scan`` with ``doc``, by which documents are told apart and ordered, and what the numbers stand for (row, doc_id, doc), if they are no doc_ids.

    Where no two rows share a doc_id, or have none, it is the doc_id (NO_ID for none). Otherwise
    rows are numbered in the order of doc_id (none last) and row; rows alike in both are one.
    """
    given = F.coalesce("doc_id", F.lit(NO_ID))
    if scan.groupBy(given.alias("doc")).agg(F.min("row").alias("least"), F.max("row").alias("last")).where("least <> last").isEmpty():
        return scan.withColumn("doc", given), None
    rows = scan.select(F.lit("").alias("tree"), given.alias("given"), "row", "doc_id").distinct()
    names = cut(ranked(rows, "given", "row").select("row", "doc_id", F.col("rank").alias("doc")))
    return scan.join(names.select("row", "doc"), "row"), names


def _doc_ids(rows: DataFrame, names: DataFrame | None, column: str) -> DataFrame:
    """``rows`` with the doc_ids that the numbers in ``column`` stand for."""
    if names is None:
        return rows.withColumn(column, F.nullif(F.col(column), F.lit(NO_ID)))
    own = names.select(F.col("doc").alias("_number"), F.col("doc_id").alias("_id"))
    return rows.join(own, F.col(column) == F.col("_number")).withColumn(column, F.col("_id")).drop("_number", "_id")


def seeds_of(scan: DataFrame) -> DataFrame:
    """The chosen windows that two documents have: row, doc, top, key, first, gap, run, own (no document before has it)."""
    chosen = scan.where(F.size("keys") > 0).select("row", "doc", "top", F.inline(F.arrays_zip("keys", "firsts", "gaps", "runs"))).toDF("row", "doc", "top", "key", "first", "gap", "run")
    return cut(chosen.join(_several(chosen.select("key", "doc"), "key"), "key").select("row", "doc", "top", "key", "first", "gap", "run", (F.col("at") == F.col("doc")).alias("own")))


def _marked(starts: np.ndarray, lasts: np.ndarray, low: int, n: int) -> np.ndarray:
    """Which of ``n`` places from ``low`` on lie in one of the ranges (lasts included)."""
    marks = np.zeros(n + 1, dtype=np.int64)
    np.add.at(marks, np.clip(starts - low, 0, n), 1)
    np.add.at(marks, np.clip(lasts + 1 - low, 0, n), -1)
    return np.cumsum(marks)[:-1] > 0


def open_sides(first: np.ndarray, gap: np.ndarray, own: np.ndarray, state: np.ndarray, top: int, spread: int = REACH - WINDOW):
    """What is left to be looked at in a text, given its seeds in order.

    ``state`` of a seed's run to the next seed: 0 if no other document has it, 1 if this document
    is the first of several, 2 if one before has it. Yields (units, asks): units are (first, last,
    seed) of windows that are known to repeat; asks are (seed, right, left), the nearest and the
    farthest window on each side of a seed, up to ``spread`` away, that is not known; -1 for none.

    A window with an earlier document in a run of REACH words stands within ``spread`` of a seed
    that this document is not the first to have; that is why runs of state 1 end there.
    """
    low = max(int(first[0]) - spread, 0)
    n = min(int(first[-1]) + spread, top) - low + 1
    foreign = _marked(first[~own] - spread, first[~own] + spread, low, n)
    known = _marked(first[state == 2], (first + gap)[state == 2], low, n)
    mine = _marked(first[state == 1], (first + gap)[state == 1], low, n) & ~foreign
    units = [(int(first[i]), int(first[i] + gap[i]), i) for i in np.flatnonzero(state == 2).tolist()]
    for i in np.flatnonzero(state == 1).tolist():
        inside = np.flatnonzero(mine[first[i] - low : first[i] + gap[i] - low + 1]) + first[i]
        for part in np.split(inside, np.flatnonzero(np.diff(inside) > 1) + 1) if len(inside) else ():
            units.append((int(part[0]), int(part[-1]), i))
    left = np.flatnonzero(_marked(first - spread, first + spread, low, n) & ~known & ~mine) + low
    at, after, before = (np.searchsorted(left, x, side) for x, side in ((first, "left"), (first + spread, "right"), (first - spread, "left")))
    asks = []
    for i in np.flatnonzero((after > at) | (at > before)).tolist():
        x = first[i]
        right = (int(left[at[i]] - x), int(left[after[i] - 1] - x)) if after[i] > at[i] else (-1, -1)
        back = (int(x - left[at[i] - 1]), int(x - left[before[i]])) if at[i] > before[i] else (-1, -1)
        asks.append((i, right, back))
    return units, asks


UNIT = "struct<first:int,last:int,at:long,n:long>"
ASK = "struct<key:long,near_right:int,far_right:int,near_left:int,far_left:int>"
SIDES = ("near_right", "far_right", "near_left", "far_left")


def known_runs(seeds: DataFrame) -> DataFrame:
    """For each row with seeds: row, doc, units (windows known to repeat) and asks (windows to be looked at, by seed)."""
    met = _several(seeds.where("gap > 0").select("run", "doc"), "run")
    told = seeds.join(met, "run", "left")  # a last seed has the hash of its own window as its run
    state = F.when(F.col("at").isNull() | (F.col("gap") == 0), 0).when(F.col("at") == F.col("doc"), 1).otherwise(2)
    each = F.struct("first", "key", "gap", "own", state.alias("state"), F.coalesce("at", "doc").alias("at"), F.coalesce("n", F.lit(0)).alias("n"))
    grouped = told.groupBy("row", "doc", "top").agg(F.array_sort(F.collect_set(each)).alias("seeds"))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units, asks, unit_ends, ask_ends = [], [], [], []
            for top, seeds in zip(batch.column(2).to_pylist(), batch.column(3)):
                first, key, gap, own, state, at, n = (seeds.values.field(i).to_numpy(zero_copy_only=False) for i in range(7))
                found, open_ = open_sides(first.astype(np.int64), gap.astype(np.int64), own.astype(bool), state, top)
                units += [(a, b, at[i], n[i]) for a, b, i in found]
                asks += [(key[i], *right, *left) for i, right, left in open_]
                unit_ends.append(len(units))
                ask_ends.append(len(asks))
            nested = []
            for rows, ends, names, types in ((units, unit_ends, ("first", "last", "at", "n"), ("i4", "i4", "i8", "i8")), (asks, ask_ends, ("key", *SIDES), ("i8", "i4", "i4", "i4", "i4"))):
                columns = list(zip(*rows)) or [()] * len(names)
                nested.append(_lists(ends, pa.StructArray.from_arrays([pa.array(np.array(c, dtype=t)) for c, t in zip(columns, types)], names=list(names))))
            yield pa.record_batch([batch.column(0), batch.column(1), *nested], names=["row", "doc", "units", "asks"])

    return cut(grouped.mapInArrow(look, f"row long, doc long, units array<{UNIT}>, asks array<{ASK}>"))


def wanted_windows(seeds: DataFrame, known: DataFrame) -> DataFrame:
    """(row, spots): around which words of each row windows are to be hashed.

    Where one document asks for windows beside a seed, all that have the seed hash the same ones.
    """
    asks = known.select(F.inline("asks"))
    # -1 stands for none and must not be the nearest.
    near = [F.min(F.when(F.col(c) >= 0, F.col(c))).alias(c) for c in SIDES if c.startswith("near")]
    far = [F.max(c).alias(c) for c in SIDES if c.startswith("far")]
    asked = cut(asks.groupBy("key").agg(*near, *far))
    spots = seeds.select("row", "key", "first").join(asked, "key")
    return spots.groupBy("row").agg(F.collect_set(F.struct("first", *[F.coalesce(c, F.lit(-1)).alias(c) for c in SIDES])).alias("spots"))


def near_windows(h: np.ndarray, first: np.ndarray, sides: list[np.ndarray], size: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, last, hash) of the windows of a text that are asked for beside its seeds; equal ones in a row are one."""
    near_right, far_right, near_left, far_left = sides
    right, left = far_right >= 0, far_left >= 0
    starts = np.concatenate([(first + near_right)[right], (first - far_left)[left]])
    lasts = np.concatenate([(first + far_right)[right], (first - near_left)[left]])
    at = np.flatnonzero(_marked(starts, lasts, 0, max(len(h) - size + 1, 0)))
    if not len(at):
        return at, at, np.zeros(0, dtype=np.uint64)
    own = span_hashes(h, at, at + size)
    fresh = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (at[1:] != at[:-1] + 1)]))
    return at[fresh], at[np.concatenate([fresh[1:] - 1, [len(at) - 1]])], own[fresh]


AGAIN_DDL = "row long, doc long, classes array<binary>, sets array<array<long>>, keys array<long>, firsts array<int>, lasts array<int>"


def read_again(docs: DataFrame, numbers: DataFrame, spots: DataFrame, names: DataFrame | None) -> DataFrame:
    """Of the rows that have any: the shingles of the paragraphs ``numbers`` and the windows about ``spots``."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_slices(batches):
            classes, sets, ends, parts, sizes = [], [], [], [], []
            for text, wanted, spots in zip(part.column(2), part.column(3), part.column(4)):
                wanted, flat, at = set(wanted.as_py() or ()), [], []
                for number, _, _, words in paragraphs(text.as_py()):
                    if number in wanted:
                        at.append((len(flat), len(words)))
                        classes.append(class_of(words))
                    flat += words
                h = word_hashes(flat)
                sets += [np.unique(shingles_of(h[a : a + n])).view(np.int64) for a, n in at]
                ends.append(len(sets))
                if spots.is_valid:
                    first, *sides = (spots.values.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(5))
                    parts.append(near_windows(h, first, sides))
                sizes.append(len(parts[-1][0]) if spots.is_valid else 0)
            first, last, key = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, dtype=np.uint64),) * 3
            stops = np.cumsum(sizes)
            columns = [part.column(0), part.column(1), _lists(ends, pa.array(classes, pa.binary())), _lists(ends, pa.array(sets, pa.list_(pa.int64())))]
            columns += [_lists(stops, _signed(key)), _lists(stops, pa.array(first.astype(np.int32))), _lists(stops, pa.array(last.astype(np.int32)))]
            yield pa.record_batch(columns, names=[x.split()[0] for x in AGAIN_DDL.split(", ")])

    wanted = numbers.join(spots, "row", "full")
    own = named_rows(docs).select("row", F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), "text")
    if names is not None:
        own = own.drop("doc").join(names.select("row", "doc"), "row")
    met = own.join(wanted, "row")
    return cut(met.select("row", "doc", "text", "numbers", "spots").mapInArrow(read, AGAIN_DDL))


def passages_of(scan: DataFrame, known: DataFrame, again: DataFrame, names: DataFrame | None, size: int = WINDOW) -> DataFrame:
    """The passages of ``repeated_passages``, from the tables of one run."""
    windows = again.where(F.size("keys") > 0).select("row", "doc", F.inline(F.arrays_zip("keys", "firsts", "lasts"))).toDF("row", "doc", "key", "first", "last")
    looked = windows.join(_several(windows.select("key", "doc"), "key"), "key").select("row", "doc", "first", "last", "at", "n")
    met = looked.unionByName(known.select("row", "doc", F.inline("units"))).withColumn("removed", F.col("doc") != F.col("at"))
    if not scan.groupBy("row").count().where("count > 1").isEmpty():
        # Rows alike in doc_id and text have the same windows; they are brought together before they meet in a task.
        met = met.groupBy("row", "doc", "removed", "first", "last").agg(F.min("at").alias("at"), F.max("n").alias("n"))
    own = Window.partitionBy("row", "removed").orderBy("first", "last")
    before = F.max("last").over(own.rowsBetween(Window.unboundedPreceding, -1))
    apart = met.withColumn("new", F.when(before.isNull() | (F.col("first") - before > 1), 1).otherwise(0))
    joined = apart.withColumn("passage", F.sum("new").over(own.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    n_words = (F.max("last") - F.min("first") + size).cast("long").alias("n_words")
    told = joined.groupBy("row", "doc", "removed", "passage").agg(F.min("first").cast("long").alias("first_word"), n_words, F.min("at").alias("cluster_id"), F.max("n").alias("cluster_size"))
    told = told.select(F.col("doc").alias("doc_id"), "row", "first_word", "n_words", "cluster_id", "cluster_size", "removed")
    return _doc_ids(_doc_ids(told, names, "doc_id"), names, "cluster_id")


def _groups(sets: list[np.ndarray], similarity: float) -> Iterator[tuple[int, int]]:
    """Links that join all sets within reach of each other; one for each set that is joined, with the first of its group.

    From each set in turn, all sets not yet reached are compared at once, so what is reached
    early is never compared again. A group that meets in several buckets has the same links there.
    """
    left = np.arange(len(sets))
    sizes = np.array([len(s) for s in sets])
    while len(left) > 1:
        first = int(left[0])
        queue, left = deque([first]), left[1:]
        while queue and len(left):
            one = queue.popleft()
            mine = len(sets[one])
            # Jaccard can only reach the threshold if the sizes are close enough.
            near = left[(sizes[left] >= similarity * mine) & (sizes[left] * similarity <= mine)]
            if not len(near):
                continue
            flat = np.concatenate([sets[i] for i in near])
            ends = np.cumsum(sizes[near])
            shared = np.add.reduceat(np.isin(flat, sets[one]), ends - sizes[near])
            linked = near[shared >= similarity * (mine + sizes[near] - shared)]
            for other in linked.tolist():
                yield first, other
                queue.append(other)
            left = left[~np.isin(left, linked)]


def _verify(similarity: float):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, 2, TASK_ROWS):
            key, unit, node = table.column(0).to_numpy(), table.column(1).to_numpy(), table.column(2).to_pylist()  # a binary key is an object array
            shingles = table.column(3).combine_chunks()
            flat, cuts = shingles.values.to_numpy(), shingles.offsets.to_numpy()
            edges = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (unit[1:] != unit[:-1]), [True]]))
            a, b = [], []
            for s, e in zip(edges[:-1].tolist(), edges[1:].tolist()):
                for one, other in _groups([flat[cuts[i] : cuts[i + 1]] for i in range(s, e)], similarity) if e - s > 1 else ():
                    a.append(node[s + one])
                    b.append(node[s + other])
            yield pa.record_batch([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    return verify


def jaccard_distance(x: Column, y: Column) -> Column:
    """Of two sets without repeats, rounded so that a similarity that is just met counts as met."""
    shared = F.size(F.array_intersect(x, y))
    return F.round(1 - shared / (F.size(x) + F.size(y) - shared), 12)


def verified_links(rows: DataFrame, similarity: float, buckets: DataFrame | None = None) -> DataFrame:
    """Links (a, b) between the classes of each bucket whose shingle sets are similar enough.

    ``rows`` has key (the bucket), class and shingles; links join whatever is in reach. ``buckets``
    has the same keys, as often, where that is cheaper to count.
    """

    units, linked = in_units(rows, "key", "class", BUCKET_ROWS, buckets, "shingles", jaccard_distance, round(1 - similarity, 12))
    met = units.select("key", "unit", "class", "shingles").repartition("key", "unit").sortWithinPartitions("key", "unit", "class").mapInArrow(_verify(similarity), "a binary, b binary")
    return met if linked is None else met.union(linked)


def bucketed(scan: DataFrame, bands: int) -> tuple[DataFrame, DataFrame]:
    """(classes, buckets): each class (class, n, and where it first stands: row, number), and the bands (key, class) that several have."""
    paras = scan.select("row", F.inline(F.arrays_zip("numbers", "classes", "bands"))).toDF("row", "number", "class", "bands")
    keys = [f"band{b}" for b in range(bands)]
    told = paras.select("class", "row", "number", *[F.get("bands", F.lit(b)).alias(k) for b, k in enumerate(keys)])
    # Min and first of numbers, so that Spark aggregates by hash, before the shuffle already.
    grouped = told.groupBy("class").agg(F.count("*").alias("n"), F.min("row").alias("row"), F.min_by("number", "row").alias("number"), *[F.first(k).alias(k) for k in keys])
    classes = cut(grouped)
    keyed = classes.where(F.col(keys[0]).isNotNull()).select(F.explode(F.array(*keys)).alias("key"), "class")
    shared = keyed.groupBy("key").agg(F.count("*").alias("met")).where("met > 1").select("key")
    return classes.select("class", "n", "row", "number"), cut(keyed.join(shared, "key").select("key", "class"))


def clusters(classes: DataFrame, buckets: DataFrame, again: DataFrame, similarity: float) -> DataFrame:
    """(class, cluster) of the classes that stand more than once or have near copies.

    A cluster is named by its least class; classes of one cluster are linked by Jaccard similarity.
    """
    sets = again.where(F.size("classes") > 0).select(F.inline(F.arrays_zip("classes", "sets"))).toDF("class", "shingles").dropDuplicates(["class"])
    joined = connected_components(verified_links(buckets.join(sets, "class").select("key", "class", "shingles"), similarity, buckets)).withColumnRenamed("node", "class")
    named = classes.select("class", "n").join(joined, "class", "left")
    return named.where("n > 1 OR component IS NOT NULL").select("class", F.coalesce("component", "class").alias("cluster"))


def lines_of(scan: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of the kind ``line`` of ``repeated_paragraphs``, given the clusters, and the row of each."""
    paras = scan.select("doc_id", "row", F.inline(F.arrays_zip("numbers", "starts", "lengths", "sizes", "classes"))).toDF("doc_id", "row", "number", "start", "length", "n_words", "class")
    members = paras.join(found, "class")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.col("number"), "class")
    firsts = members.groupBy("cluster").agg(F.min(order).alias("first"), F.count("*").alias("cluster_size"))
    told = members.join(firsts, "cluster")
    whole = [F.col(c).cast("long").alias(n) for c, n in (("number", "paragraph"), ("start", "start"), ("length", "length"), ("n_words", "n_words"))]
    return told.select("doc_id", "row", *whole, F.col("first.doc_id").alias("cluster_id"), "cluster_size", (order != F.col("first")).alias("removed"))


def _found(docs: DataFrame, similarity: float) -> tuple[DataFrame, DataFrame]:
    """(lines, passages) of ``docs``, each with the row that it stands in."""
    bands, rows = tune_bands(similarity)
    scan, names = told_apart(cut(scanned(docs, bands, rows)))
    classes, buckets = bucketed(scan, bands)
    numbers = classes.join(buckets, "class", "left_semi").groupBy("row").agg(F.collect_set("number").alias("numbers"))
    seeds = seeds_of(scan)
    known = known_runs(seeds)
    again = read_again(docs, numbers, wanted_windows(seeds, known), names)
    return lines_of(scan, clusters(classes, buckets, again, similarity)), passages_of(scan, known, again, names)


def repeated_passages(docs: DataFrame) -> DataFrame:
    """doc_id, row, first_word, n_words, cluster_id, cluster_size, removed of each passage that other documents have too.

    A passage is a run of words each window of which other documents have. It is removed where a
    document before has each of its windows (in the order of doc_id, null last); cluster_id is
    the first of those documents, cluster_size the most often that a window, or a run between
    two seeds, stands anywhere. Rows that share a doc_id, or have none, are documents of their own,
    ordered by ``row``, a hash of doc_id and text; rows alike in both are one document.
    """
    scan, names = told_apart(cut(scanned(docs.select("doc_id", "text"), 0, 0)))
    seeds = seeds_of(scan)
    known = known_runs(seeds)
    none = docs.sparkSession.createDataFrame([], "row long, numbers array<int>")
    return passages_of(scan, known, read_again(docs, none, wanted_windows(seeds, known), names), names)


def repeated_paragraphs(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The paragraphs and passages of ``docs`` (doc_id, text) that repeat.

    Rows of the kind ``line`` are the paragraphs that belong to a cluster of two or more: doc_id,
    paragraph (its line), start and length (code points), n_words, cluster_id (the smallest
    doc_id in it), cluster_size, removed (all but the first by doc_id and line). Rows of the
    kind ``passage`` are runs of words that other documents have as well, from ``first_word``
    on; see ``repeated_passages``. Null and empty texts have neither; rows that repeat a doc_id
    are compared like others and, being alike in doc_id and line, are kept once. Null ids come
    last. Other columns are not read; a table without repeats, or an empty one, gives an empty
    result.
    """
    lines, passages = (x.drop("row") for x in _found(docs.select("doc_id", "text"), similarity))
    return lines.withColumn("kind", F.lit("line")).unionByName(passages.withColumn("kind", F.lit("passage")), allowMissingColumns=True)


def _without(text: str, lines: set[int], runs: list[tuple[int, int]]) -> str:
    """``text`` without the lines of these numbers and the words of these runs (first, count); a line left empty goes too."""
    kept, word = [], 0
    for number, line in enumerate(text.split("\n")):
        spans = [m.span() for m in _WORD.finditer(line)]
        gone = [any(a <= word + i < a + n for a, n in runs) for i in range(len(spans))]
        word += len(spans)
        if number in lines or (gone and all(gone)):
            continue
        for (start, end), out in zip(reversed(spans), reversed(gone)):
            if out:
                line = line[:start].rstrip(" ") + line[end:] if start else line[end:].lstrip(" ")
        kept.append(line)
    return "\n".join(kept)


def remove_repeats(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` without the lines and passages that are removed; n_chars follows if present.

    Texts from which nothing is removed stay as they are, null ones included.
    """
    names, at = docs.columns, docs.columns.index("text")
    row, lines_, runs_ = (unused(names, x) for x in ("_row", "_lines", "_runs"))
    lines, passages = _found(docs.select("doc_id", "text"), similarity)
    gone = lines.where("removed").groupBy(F.col("row").alias(row)).agg(F.collect_set("paragraph").alias(lines_))
    cut_out = passages.where("removed").groupBy(F.col("row").alias(row)).agg(F.collect_list(F.struct("first_word", "n_words")).alias(runs_))
    own = docs.withColumn(row, F.xxhash64(F.col("doc_id").cast("long"), "text"))
    joined = own.join(gone.join(cut_out, row, "full"), row, "left").select(*names, lines_, runs_)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, lines, runs in zip(batch.column(at).to_pylist(), *(batch.column(len(names) + i).to_pylist() for i in (0, 1))):
                if text is not None and (lines or runs):
                    text = _without(text, set(lines or ()), [(r["first_word"], r["n_words"]) for r in runs or ()])
                texts.append(text)
            columns = [batch.column(i) for i in range(len(names))]
            columns[at] = pa.array(texts, batch.column(at).type)
            yield pa.record_batch(columns, names=names)

    out = joined.mapInArrow(clean, docs.schema)
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(dict(docs.dtypes)["n_chars"]))
    return out.select(*names)
