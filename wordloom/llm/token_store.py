"""Operator 7: token ids in Simple-8b files.

A 64-bit word holds a selector in its top 4 bits and, below, as many ids as the selector says,
each in the same number of bits: between 60 ids of one bit and one id of 60 bits. Selector 0
is the escape: the next word is one raw 64-bit id. Ids are coded in blocks of ``BLOCK`` ids
that share no word; the offsets of the blocks let a reader decode any of them, and all words
of one selector in a block are unpacked by one vector operation.

A file is: magic, the words of all blocks, the footer, its length (8 bytes), magic. The footer
holds the number of ids, the word offset of each block, and the id and length of each document.
Tasks write files under unique names in the shared folder; only the files that a successful
task has reported are in the manifest, so attempts that were lost leave no trace in it.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import bpe
from .common import cut, new_dir, open_fs

MAGIC = b"WLIDS8B1"
BLOCK = 1 << 14
FLUSH_IDS = 1 << 20
#: Ids in a word and bits of each, by selector; selector 0 is the escape.
COUNTS = np.array([1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 1], dtype=np.int64)
BITS = np.array([64, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60, 60], dtype=np.uint64)
LAST = 14


def encode_block(ids: np.ndarray) -> np.ndarray:
    """The 64-bit words of a block of ids.

    A selector fits at a position if the bitwise OR of the ids it would take is small enough.
    The best selector of every position is found by vector operations over all positions; then
    one walk picks the positions at which words start.
    """
    n = len(ids)
    if n == 0:
        return np.zeros(0, dtype=np.uint64)
    ids = ids.astype(np.uint64, copy=False)
    wide = int(ids.max()) >> 60 != 0
    best = np.full(n, LAST, dtype=np.int8)
    if wide:
        best[ids >> np.uint64(60) != 0] = 0
    # ORs over 1, 2, 4, ... ids; beyond the end stands a value that fits no selector.
    joined = {1: np.concatenate([ids, np.full(64, np.uint64(1) << np.uint64(62), dtype=np.uint64)])}
    padded = joined[1]
    for selector in range(LAST - 1, 0, -1):
        count = int(COUNTS[selector])
        half = 1
        while 2 * half <= count:
            if 2 * half not in joined:
                joined[2 * half] = joined[half].copy()
                joined[2 * half][:-half] |= joined[half][half:]
            half *= 2
        both = joined[half][:n] | joined[half][count - half : count - half + n]
        fits = both < np.uint64(1) << BITS[selector]
        if not fits.any():
            break  # then no selector with more and narrower ids fits either
        best[fits] = selector
    step = COUNTS[best].tolist()
    starts, at = [], 0
    while at < n:
        starts.append(at)
        at += step[at]
    starts = np.array(starts, dtype=np.int64)
    chosen = best[starts]
    places = np.cumsum(np.where(chosen == 0, 2, 1)) - np.where(chosen == 0, 2, 1)
    words = np.zeros(int(places[-1]) + (2 if chosen[-1] == 0 else 1), dtype=np.uint64)
    for selector in np.unique(chosen):
        here = starts[chosen == selector]
        if selector == 0:
            words[places[chosen == 0] + 1] = ids[here]
            continue
        word = np.full(len(here), np.uint64(selector) << np.uint64(60), dtype=np.uint64)
        for k in range(int(COUNTS[selector])):
            word |= padded[here + k] << np.uint64(k * int(BITS[selector]))
        words[places[chosen == selector]] = word
    return words


def decode_block(words: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` ids of a block."""
    if n == 0:
        return np.zeros(0, dtype=np.uint64)
    selectors = (words >> np.uint64(60)).astype(np.int8)
    if not selectors.all():  # a raw word after an escape is no word of its own
        raw = np.zeros(len(words), dtype=bool)
        at = 0
        zero = np.flatnonzero(selectors == 0)
        for z in zero.tolist():
            if z >= at:
                raw[z + 1] = True
                at = z + 2
        heads = np.flatnonzero(~raw)
    else:
        heads = np.arange(len(words))
    chosen = selectors[heads]
    sizes = COUNTS[chosen]
    ends = np.cumsum(sizes)
    out = np.zeros(int(ends[-1]), dtype=np.uint64)
    for selector in np.unique(chosen):
        mine = chosen == selector
        begin = (ends - sizes)[mine]
        if selector == 0:
            out[begin] = words[heads[mine] + 1]
            continue
        word, bits = words[heads[mine]], BITS[selector]
        mask = (np.uint64(1) << bits) - np.uint64(1)
        for k in range(int(COUNTS[selector])):
            out[begin + k] = word >> np.uint64(k * int(bits)) & mask
    return out[:n]


class IdFile:
    """Writes one file, a document at a time; holds no more than FLUSH_IDS ids and a document."""

    def __init__(self, sink):
        self.sink, self.pending, self.held = sink, [], 0
        self.n_ids, self.n_words = 0, 0
        self.offsets: list[int] = []
        self.docs: list[int | None] = []
        self.sizes: list[int] = []
        sink.write(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc_id)
        self.sizes.append(len(ids))
        self.pending.append(ids)
        self.held += len(ids)
        if self.held >= FLUSH_IDS:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.pending) if self.pending else np.zeros(0, dtype=np.uint64)
        whole = len(ids) if last else len(ids) // BLOCK * BLOCK
        for at in range(0, whole, BLOCK):
            words = encode_block(ids[at : min(at + BLOCK, whole)])
            self.offsets.append(self.n_words)
            self.n_words += len(words)
            self.sink.write(words.astype("<u8").tobytes())
        self.n_ids += whole
        self.pending, self.held = [ids[whole:]], len(ids) - whole

    def close(self) -> None:
        self._flush(True)
        footer = json.dumps({"ids": self.n_ids, "block": BLOCK, "words": self.n_words, "offsets": self.offsets, "docs": self.docs, "sizes": self.sizes}).encode()
        self.sink.write(footer + struct.pack("<Q", len(footer)) + MAGIC)


class IdReader:
    """Reads a file by ranges: the footer first, then the blocks that are asked for."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        tail = source.read_at(16, size - 16)
        if tail[8:] != MAGIC:
            raise ValueError("not a token-id file")
        length = struct.unpack("<Q", tail[:8])[0]
        self.footer = json.loads(source.read_at(length, size - 16 - length))

    def blocks(self, first: int, last: int) -> np.ndarray:
        """The ids of blocks ``first`` to ``last`` (exclusive)."""
        f = self.footer
        offsets = [*f["offsets"], f["words"]]
        raw = np.frombuffer(self.source.read_at((offsets[last] - offsets[first]) * 8, len(MAGIC) + offsets[first] * 8), dtype="<u8")
        parts = []
        for b in range(first, last):
            n = min(f["block"], f["ids"] - b * f["block"])
            parts.append(decode_block(raw[offsets[b] - offsets[first] : offsets[b + 1] - offsets[first]], n))
        return np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64)

    def documents(self, step: int = 64) -> Iterator[tuple[int | None, np.ndarray]]:
        """(doc_id, ids) in file order; decodes ``step`` blocks at a time."""
        f, held, at = self.footer, np.zeros(0, dtype=np.uint64), 0
        pieces: list[np.ndarray] = []
        have = 0
        for doc_id, size in zip(f["docs"], f["sizes"]):
            while have < size:
                more = self.blocks(at, min(at + step, len(f["offsets"])))
                at += step
                pieces.append(more)
                have += len(more)
            if len(pieces) != 1:
                held = np.concatenate(pieces) if pieces else held
            else:
                held = pieces[0]
            yield doc_id, held[:size]
            pieces, have = [held[size:]], have - size


def write_ids(docs: DataFrame, folder: str, end_id: int = 2, vocabulary: str | None = None) -> DataFrame:
    """Encode ``docs`` (doc_id, text) and write Simple-8b files in ascending doc_id order.

    Returns the manifest: part (ascending with doc_id), path, n_docs, n_ids, start (ids in all
    parts before). Null and empty texts have the end id alone. Null doc_ids come first; rows
    that repeat a doc_id stand in the order of their texts. Other columns are not read. An
    empty table gives an empty manifest.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, end = bpe.encoder(vocabulary), struct.pack("<I", end_id)
        part, file, sink, path = TaskContext.get().partitionId(), None, None, ""
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if file is None:
                    fs, root = open_fs(folder)
                    fs.create_dir(root, recursive=True)
                    path = f"{root}/ids-{part:06d}-{uuid.uuid4().hex}.s8b"
                    sink = fs.open_output_stream(path)
                    file = IdFile(sink)
                file.add(doc_id, np.frombuffer(encoder.encode(text.as_py()) + end, dtype="<u4"))
        if file is not None:
            file.close()
            sink.close()
            row = {"part": [part], "path": [f"{folder}/{path.rsplit('/', 1)[1]}"], "n_docs": [len(file.docs)], "n_ids": [file.n_ids]}
            yield pa.RecordBatch.from_pydict(row, schema=pa.schema([("part", pa.int64()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]))

    # The start of the text parts rows of one doc_id, or of none, in the order in which they are sorted.
    ordered = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange("doc_id", F.substring("text", 1, 32)).sortWithinPartitions("doc_id", "text")
    written = cut(ordered.mapInArrow(write, "part long, path string, n_docs long, n_ids long"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return written.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))  # a row a file


def read_ids(manifest: DataFrame) -> DataFrame:
    """Every document of the files in a manifest: doc_id, start, n_tokens, ids_crc32."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                fs, name = open_fs(path)
                with fs.open_input_file(name) as source:
                    rows = []
                    for doc_id, ids in IdReader(source).documents():
                        rows.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                        start += len(ids)
                    yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*rows)], schema=schema)

    files = manifest.repartitionByRange(max(manifest.count(), 1), "part").select("path", "start")  # a task for each file
    return files.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Write the ids of ``docs`` under the shared folder and read the files back."""
    return read_ids(write_ids(docs, new_dir(spark, "token-ids")))
