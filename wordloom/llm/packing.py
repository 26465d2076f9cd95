"""Operator 3: vector bin packing of examples into training sequences.

An example needs amounts of several things at once: tokens, one segment, and tokens that bear
loss. A sequence is a bin with a limit on each. Bins are filled one after another from a pool
of waiting examples: the next one in is the example that fits and has the greatest dot product
of its needs with the room left, each need weighted by how scarce it is in the pool. Where cuts
are allowed, an example larger than a sequence yields full sequences first, and a bin that
nothing fits is topped up with the first part of a waiting example.

Packing is done within each partition, from a pool of bounded size, so there is no shuffle and
a lost task is simply run again. With cuts and padding that spares powers of two, what is left
at the end of a partition is cut into sequences whose lengths are powers of two, unpadded.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe
from .common import tidy

POOL = 256
#: Sequence ids of a partition start at its number times this.
STRIDE = 1 << 40


@dataclass(frozen=True)
class Limits:
    tokens: int = 2048
    segments: int = 256
    loss: int = 2048


@dataclass
class Example:
    """Ids of a document or conversation from ``start`` on; ``loss`` has a byte (0 or 1) an id, or None for all."""

    key: int | None
    ids: np.ndarray
    start: int
    total: int
    loss: np.ndarray | None = None

    def needs(self) -> tuple[int, int, int]:
        return len(self.ids), 1, len(self.ids) if self.loss is None else int(self.loss.sum())

    def cut(self, n: int) -> tuple["Example", "Example"]:
        """The first ``n`` ids and the rest."""
        first, rest = (None, None) if self.loss is None else (self.loss[:n], self.loss[n:])
        return Example(self.key, self.ids[:n], self.start, self.total, first), Example(self.key, self.ids[n:], self.start + n, self.total, rest)

    def prefix(self, tokens: int, loss: int) -> int:
        """How many ids can be taken under both amounts."""
        n = min(tokens, len(self.ids))
        if self.loss is None:
            return min(n, loss)
        return min(n, int(np.searchsorted(np.cumsum(self.loss[:n]), loss, side="right")))


class Packer:
    """Fills sequences from a stream of examples; yields each as a list of examples."""

    def __init__(self, limits: Limits, cuts: bool, pool: int = POOL):
        if min(limits.tokens, limits.segments, limits.loss) < 1:
            raise ValueError("every limit must be at least 1")
        self.limits, self.cuts, self.size = np.array([limits.tokens, limits.segments, limits.loss], dtype=np.int64), cuts, pool
        self.waiting: list[Example] = []
        self.needs = np.zeros((0, 3), dtype=np.int64)

    def add(self, example: Example) -> Iterator[list[Example]]:
        while True:
            needs = example.needs()
            if needs[0] <= self.limits[0] and needs[2] <= self.limits[2]:
                break
            if not self.cuts:
                raise ValueError(f"example {example.key} needs {needs}, more than a sequence holds")
            if (n := example.prefix(int(self.limits[0]), int(self.limits[2]))) == self.limits[0]:
                piece, example = example.cut(n)
                yield [piece]
            else:  # the loss limit binds first: both parts wait like others
                piece, example = example.cut(n)
                yield from self._wait(piece)
        if needs[0]:
            yield from self._wait(example)

    def _wait(self, example: Example) -> Iterator[list[Example]]:
        self.waiting.append(example)
        if len(self.waiting) >= 2 * self.size:
            yield from self._fill(self.size)

    def _fill(self, leave: int) -> Iterator[list[Example]]:
        """Close bins until ``leave`` examples wait."""
        while len(self.waiting) > leave:
            needs = np.array([x.needs() for x in self.waiting], dtype=np.int64).reshape(-1, 3)
            alive = np.ones(len(needs), dtype=bool)
            share = needs / self.limits
            weights = share.mean(axis=0)
            while alive.sum() > leave:
                room, inside = self.limits.copy(), []
                while True:
                    fits = alive & (needs <= room).all(axis=1)
                    if not fits.any():
                        break
                    score = np.where(fits, share @ (weights * room / self.limits), -1.0)
                    best = int(score.argmax())
                    inside.append(self.waiting[best])
                    room -= needs[best]
                    alive[best] = False
                if self.cuts and room[0] and room[1] and room[2] and alive.any():
                    best = int(np.where(alive, needs[:, 0], -1).argmax())
                    n = self.waiting[best].prefix(int(room[0]), int(room[2]))
                    if n:
                        piece, rest = self.waiting[best].cut(n)
                        inside.append(piece)
                        self.waiting[best] = rest
                        needs[best] = rest.needs()
                        share[best] = needs[best] / self.limits
                yield inside
                if self.cuts and sum(len(x.ids) for x, a in zip(self.waiting, alive) if a) < self.limits[0]:
                    break
            self.waiting = [x for x, a in zip(self.waiting, alive) if a]
            if self.cuts and sum(len(x.ids) for x in self.waiting) < self.limits[0]:
                break

    def finish(self, powers: bool) -> Iterator[list[Example]]:
        """Everything that still waits. ``powers``: cut so that lengths are powers of two."""
        if not (self.cuts and powers):
            yield from self._fill(0)
            while self.waiting:
                rest, self.waiting = self.waiting, []
                yield from self._leftover(rest)
            return
        yield from self._fill(0)
        rest, self.waiting = self.waiting, []
        for one in self._leftover(rest):
            length = sum(len(x.ids) for x in one)
            while length:
                size = 1 << (length.bit_length() - 1)
                inside, got = [], 0
                while got < size:
                    x = one.pop(0)
                    if len(x.ids) > size - got:
                        x, more = x.cut(size - got)
                        one.insert(0, more)
                    inside.append(x)
                    got += len(x.ids)
                yield inside
                length -= size

    def _leftover(self, rest: list[Example]) -> Iterator[list[Example]]:
        """The last examples in order, a new bin whenever a limit would be passed."""
        inside, used = [], np.zeros(3, dtype=np.int64)
        for x in rest:
            need = np.array(x.needs())
            if inside and (used + need > self.limits).any():
                yield inside
                inside, used = [], np.zeros(3, dtype=np.int64)
            inside.append(x)
            used += need
        if inside:
            yield inside


SCHEMA = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "loss_tokens")])
DDL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, loss_tokens long"


def _emit(sequences: Iterator[list[Example]], number: list[int], with_ids: bool, chunk: int = 4096) -> Iterator[pa.RecordBatch]:
    rows, ids = [], []

    def batch():
        columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
        if with_ids:
            return pa.record_batch([*columns, pa.array(ids, pa.list_(pa.int64()))], names=[*SCHEMA.names, "ids"])
        return pa.record_batch(columns, schema=SCHEMA)

    for inside in sequences:
        offset = 0
        for x in inside:
            tokens, _, loss = x.needs()
            rows.append((x.key, x.start, tokens, zlib.crc32(x.ids.tobytes()), x.total, number[0], offset, loss))
            if with_ids:
                ids.append(x.ids)
            offset += tokens
        number[0] += 1
        if len(rows) >= chunk:
            yield batch()
            rows, ids = [], []
    if rows:
        yield batch()


def pack_documents(docs: DataFrame, limits: Limits = Limits(), end_id: int = 1, vocabulary: str | None = None, with_ids: bool = False) -> DataFrame:
    """Pack the texts of ``docs`` (doc_id, text) into sequences; a row for each piece.

    Every id of a document, the end id included, lies in one piece; all its ids bear loss. Null
    and empty texts are packed as the end id alone; rows that repeat a doc_id, or have none, are
    packed each by itself; other columns are not read; an empty table gives no rows.
    ``with_ids`` adds the ids themselves, for writing the sequences out.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, end = bpe.encoder(vocabulary), struct.pack("<I", end_id)
        packer, number = Packer(limits, cuts=True), [TaskContext.get().partitionId() * STRIDE]

        def sequences():
            for batch in tidy(batches):
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    ids = np.frombuffer(encoder.encode(text.as_py()) + end, dtype="<u4")
                    yield from packer.add(Example(doc_id, ids, 0, len(ids)))
            yield from packer.finish(powers=True)

        yield from _emit(sequences(), number, with_ids)

    ddl = DDL + (", ids array<long>" if with_ids else "")
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(pack, ddl)


def pack_conversations(turns: DataFrame, limits: Limits = Limits(), end_id: int = 1, vocabulary: str | None = None, with_ids: bool = False) -> DataFrame:
    """Pack conversations (conv_id, turn, role, text) whole; only the assistant's tokens bear loss.

    A turn is its text and the end id. Conversations are gathered by conv_id, turns in order;
    a conversation that no sequence can hold alone is cut like a document. Null texts count as
    empty, null roles as the user's, null turns come first. doc_id in the result is the conv_id.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, end = bpe.encoder(vocabulary), struct.pack("<I", end_id)
        packer, number = Packer(limits, cuts=True), [TaskContext.get().partitionId() * STRIDE]

        def example(key, parts):
            ids = np.frombuffer(b"".join(x for x, _ in parts), dtype="<u4")
            loss = np.concatenate([np.full(len(x) // 4, y, dtype=np.uint8) for x, y in parts])
            return Example(key, ids, 0, len(ids), loss)

        def sequences():
            key, parts = None, []
            for batch in tidy(batches):
                for conv_id, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                    if parts and conv_id != key:
                        yield from packer.add(example(key, parts))
                        parts = []
                    key = conv_id
                    parts.append((encoder.encode(text) + end, role == "assistant"))
            if parts:
                yield from packer.add(example(key, parts))
            yield from packer.finish(powers=False)

        yield from _emit(sequences(), number, with_ids)

    ddl = DDL + (", ids array<long>" if with_ids else "")
    ordered = turns.select(F.col("conv_id").cast("long"), "turn", "role", "text").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(pack, ddl)
