"""Operator 12: two tokenizers' tokens of the same texts, aligned by their bytes.

Tokens of either side that share bytes are linked in a bipartite graph. Its connected components,
found by union-find over the overlaps, are the minimal groups: no offset inside one ends a token
of both sides. The members of a component that end together are its links. How often each pair of
ids is linked is counted over the whole corpus, and every text is told how its links fare.

Neither tokenizer joins characters across a lone space or line break between two others, so the
words of a text are aligned one by one and a bounded memo keeps what is known of them; the words
of several texts that are not in it are encoded and aligned at once. A text with any other white
space, or with a word that a tokenizer changes, is aligned as a whole.

A text is read once. What is written between the steps are its counts and its distinct pairs.
Pairs are counted with partial sums, and the counts go back to the texts by a join of which only
the most frequent pairs are broadcast: at most PAIRS of them have more than their share of all links.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .buckets import merge
from .common import cut, tidy

MEMO_WORDS = 300_000
SLICE_ROWS = 64
#: Pairs of ids are numbers of so many bits.
CODE_BITS = 44
#: So many pairs at most are broadcast.
PAIRS = 1_000_000
#: The mark that the second tokenizer's pieces have for a space.
SPACE = "▁"
_aligners: dict[tuple[str, str, int], "Aligner"] = {}


def components_of(a_sizes: np.ndarray, b_sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(component of each A token, of each B token, A token and B token of each link), for tokens of ``a_sizes`` and ``b_sizes`` bytes over the same bytes."""
    a_ends, b_ends = np.cumsum(a_sizes), np.cumsum(b_sizes)
    ends = np.union1d(a_ends, b_ends)  # between two of them lies an overlap of one A and one B token
    a, b = np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)
    label = merge(np.arange(len(a_ends) + len(b_ends)), a, len(a_ends) + b)
    number = np.cumsum(label[: len(a_ends)] == np.arange(len(a_ends))) - 1  # a component's label is its first A token
    together = (a_ends[a] == ends) & (b_ends[b] == ends)
    return number, number[label[len(a_ends) :]], a[together], b[together]


class Aligner:
    """Both tokenizers, their tokens' bytes, and what is known of words that were seen."""

    def __init__(self, a_path: str, b_path: str, memo: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        splitter = json.loads(self.a.pre_tokenizer.__getstate__()) if self.a.pre_tokenizer else {}
        if self.a.normalizer or splitter.get("type") != "ByteLevel" or splitter.get("add_prefix_space") or not splitter.get("use_regex", True):
            raise ValueError("the first vocabulary must be byte-level, without a normalizer or an added first space")
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        # A byte-level vocabulary writes bytes without a printable Latin-1 character from U+0100 on.
        printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
        byte = {chr(b): b for b in printable} | {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in printable)}
        vocabulary = self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        #: Words can be taken one by one if no piece goes on after a space or holds a line break.
        self.by_word = not any(SPACE in p.lstrip(SPACE) or "\n" in p for p in pieces)
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in t], dtype=np.int64) for t in (self.a_bytes, self.b_bytes))
        self.n_b = len(pieces)
        if len(self.a_bytes) * self.n_b >> CODE_BITS:
            raise ValueError("the vocabularies have too many pairs of ids")
        # What is written for a token: its id and "," inside, "|" or ";" at the end of its side of a group.
        self.written = [f"{i}{end}".encode() for i in range(len(self.a_bytes)) for end in ",|"] + [f"{i}{end}".encode() for i in range(self.n_b) for end in ",;"]
        self.widths = np.array([len(x) for x in self.written], dtype=np.int64)
        self.begin_line = self.b.encode("\n")
        self.memo = memo
        self._forget()

    def _forget(self) -> None:
        self.first: dict[str, int] = {}  # words at the start of a line
        self.inner: dict[str, int] = {}  # words after a space
        self.strings: list[bytes] = []
        self.counts = np.zeros((0, 4), dtype=np.int64)  # A tokens, B tokens, components, links
        self.codes = np.zeros(0, dtype=np.int64)
        self.newline = self._learn(["\n"], [self.a.encode("\n", add_special_tokens=False).ids], [self.begin_line[1:]])[0]

    def _align(self, parts: list[bytes], a_ids: list[list[int]], b_ids: list[list[int]]):
        """(which parts have the same bytes on both sides, and of those: counts, strings, codes one after the other)."""
        fits = [b"".join([self.a_bytes[i] for i in a]) == p == b"".join([self.b_bytes[i] for i in b]) for p, a, b in zip(parts, a_ids, b_ids)]
        if not all(fits):
            a_ids, b_ids = ([x for x, ok in zip(ids, fits) if ok] for ids in (a_ids, b_ids))
        n = len(a_ids)
        a_of, b_of = (np.repeat(np.arange(n), [len(x) for x in ids]) for ids in (a_ids, b_ids))
        a, b = (np.fromiter(chain.from_iterable(ids), dtype=np.int64, count=len(of)) for ids, of in ((a_ids, a_of), (b_ids, b_of)))
        a_in, b_in, a_at, b_at = components_of(self.a_sizes[a], self.b_sizes[b])
        n_groups = int(a_in[-1]) + 1 if len(a_in) else 0
        a_per, b_per = (np.bincount(x, minlength=n_groups) for x in (a_in, b_in))
        order = np.empty(len(a) + len(b), dtype=np.int64)
        before_b, before_a = np.cumsum(b_per) - b_per, np.cumsum(a_per)
        a_last, b_last = (np.append(x[1:] != x[:-1], True) if len(x) else np.zeros(0, bool) for x in (a_in, b_in))
        order[np.arange(len(a)) + before_b[a_in]] = 2 * a + a_last
        order[np.arange(len(b)) + before_a[b_in]] = 2 * (len(self.a_bytes) + b) + b_last
        joined = b"".join([self.written[i] for i in order.tolist()])
        tokens = np.cumsum(np.bincount(a_of, minlength=n) + np.bincount(b_of, minlength=n))
        stops = np.concatenate([[0], np.cumsum(self.widths[order])])[np.concatenate([[0], tokens])].tolist()
        strings = [joined[s:e] for s, e in zip(stops, stops[1:])]
        counts = np.stack([np.bincount(x, minlength=n) for x in (a_of, b_of, a_of[a_last], a_of[a_at])], axis=1)
        return fits, counts, strings, a[a_at] * self.n_b + b[b_at]

    def _learn(self, words: list[str], a_ids: list[list[int]], b_ids: list[list[int]]) -> list[int]:
        """Numbers of words (as they stand in the text, with a space before if there is one); -1 if a tokenizer changes it."""
        fits, counts, strings, codes = self._align([w.encode() for w in words], a_ids, b_ids)
        at = iter(range(len(self.strings), len(self.strings) + len(strings)))
        self.strings += strings
        self.counts = np.concatenate([self.counts, counts])
        self.codes = np.concatenate([self.codes, codes])
        self.begins = np.concatenate([[0], np.cumsum(self.counts[:, 3])])
        return [next(at) if ok else -1 for ok in fits]

    def _miss(self, words: set[str], first: set[str]) -> set[str]:
        """Learns words (inner ones and first ones); gives those with which no text can be taken by words."""
        odd = {w for w in words | first if w.split() != [w] or SPACE in w}
        inner, heads = sorted(words - odd), sorted(first - odd)
        if not inner and not heads:
            return odd
        whole = [" " + w for w in inner] + heads
        a_ids = [x.ids for x in self.a.encode_batch_fast(whole, add_special_tokens=False)]
        b_ids = self.b.encode(inner + ["\n" + w for w in heads], num_threads=1)
        skip = len(self.begin_line)
        b_ids[len(inner) :] = [x[skip:] if x[:skip] == self.begin_line else [] for x in b_ids[len(inner) :]]
        numbers = self._learn(whole, a_ids, b_ids)
        for known, own, found in ((self.inner, inner, numbers), (self.first, heads, numbers[len(inner) :])):
            known.update((w, i) for w, i in zip(own, found) if i >= 0)
            odd.update(w for w, i in zip(own, found) if i < 0)
        return odd

    def _whole(self, text: str):
        a_ids = self.a.encode(" " + text, add_special_tokens=False).ids
        fits, counts, strings, codes = self._align([(" " + text).encode()], [a_ids], [self.b.encode(text)])
        return (counts[0], strings[0], codes) if fits[0] else None

    def rows(self, texts: list[str | None]):
        """For each text: counts (A tokens, B tokens, components, links), the digest of its groups ('' without tokens), its pairs' codes and how often each is linked."""
        if len(self.strings) > self.memo:
            self._forget()
        lines, missing, heads = [], set(), set()
        for text in texts:
            parted = [line.split(" ") for line in text.split("\n")] if text and self.by_word else []
            lines.append(parted)
            for n, words in enumerate(parted):
                if n:
                    heads.add(words[0])
                    missing.update(words[1:])
                else:
                    missing.update(words)
        odd = self._miss(missing - self.inner.keys(), heads - self.first.keys())
        counts = np.zeros((len(texts), 4), dtype=np.int64)
        digests, found = [""] * len(texts), []
        inner, first, strings = self.inner.__getitem__, self.first.__getitem__, self.strings
        for at, (text, parted) in enumerate(zip(texts, lines)):
            if not text:
                continue
            if not parted or any(not odd.isdisjoint(words) for words in parted) and odd:
                whole = self._whole(text)
                if whole:
                    counts[at], digests[at] = whole[0], hashlib.sha256(whole[1][:-1]).hexdigest()
                    found.append((at, whole[2]))
                continue
            numbers: list[int] = list(map(inner, parted[0]))
            for words in parted[1:]:
                numbers.append(self.newline)
                numbers.append(first(words[0]))
                numbers += map(inner, words[1:])
            digests[at] = hashlib.sha256(b"".join([strings[i] for i in numbers])[:-1]).hexdigest()
            known = np.array(numbers)
            counts[at] = self.counts[known].sum(axis=0)
            size = self.counts[known, 3]
            starts = self.begins[known] - (np.cumsum(size) - size)
            found.append((at, self.codes[np.repeat(starts, size) + np.arange(int(size.sum()))]))
        codes = np.concatenate([c for _, c in found]) if found else np.zeros(0, dtype=np.int64)
        of = np.repeat([at for at, _ in found], [len(c) for _, c in found]).astype(np.int64)
        joint = np.sort(of << CODE_BITS | codes)  # by text, then code
        codes, of = joint & (1 << CODE_BITS) - 1, joint >> CODE_BITS
        fresh = np.flatnonzero(np.concatenate([[True], joint[1:] != joint[:-1]])) if len(codes) else np.zeros(0, dtype=np.int64)
        times = np.diff(np.append(fresh, len(codes)))
        ends = np.cumsum(np.bincount(of[fresh], minlength=len(texts)))
        return counts, digests, ends, codes[fresh], times


def aligner(a_path: str, b_path: str, memo: int = MEMO_WORDS) -> Aligner:
    """This Python worker's aligner for two vocabularies; its memo lives as long as the worker."""
    key = (a_path, b_path, memo)
    if key not in _aligners:
        _aligners[key] = Aligner(*key)
    return _aligners[key]


def vocabularies(a_path: str | None, b_path: str | None) -> tuple[str, str]:
    """The given files, or the public byte-level and piece vocabularies where none are given."""
    if a_path and b_path:
        return a_path, b_path
    import public_tokenizers

    return a_path or public_tokenizers.path("byte_bpe_50k.json"), b_path or public_tokenizers.path("piece_bpe_32k.model")


COUNTS = ("n_a", "n_b", "n_groups", "n_links")
ALIGNED = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, codes array<long>, times array<int>"


def aligned(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, memo: int = MEMO_WORDS) -> DataFrame:
    """Each row of ``docs`` (doc_id, text) by itself: a number of its own (row), doc_id, counts, the digest of its groups, its distinct pairs (codes) and how often each is linked (times)."""
    given = a_path, b_path

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own, row = aligner(*vocabularies(*given), memo), TaskContext.get().partitionId() << 33
        for whole in tidy(batches):
            for at in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(at, SLICE_ROWS)
                n = batch.num_rows
                counts, digests, ends, codes, times = own.rows(batch.column(1).to_pylist())
                offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
                lists = [pa.ListArray.from_arrays(offsets, pa.array(codes)), pa.ListArray.from_arrays(offsets, pa.array(times, pa.int32()))]
                columns = [pa.array(np.arange(row, row + n)), batch.column(0), *(pa.array(counts[:, i]) for i in range(4)), pa.array(digests, pa.string()), *lists]
                row += n
                yield pa.record_batch(columns, names=[c.split()[0] for c in ALIGNED.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(align, ALIGNED)


def _links(rows: DataFrame) -> DataFrame:
    return rows.where("n_links > 0").select("row", F.inline(F.arrays_zip("codes", "times"))).toDF("row", "code", "times")


def pair_counts(rows: DataFrame, n_b: int) -> DataFrame:
    """a, b, code, count and best (no pair of this b has a higher count) of each pair of ids that is linked in ``rows``."""
    counts = cut(_links(rows).groupBy("code").agg(F.sum("times").alias("count")))
    named = counts.select(F.expr(f"code div {n_b}").alias("a"), (F.col("code") % n_b).alias("b"), "code", "count")
    highest = named.groupBy("b").agg(F.max("count").alias("highest"))
    return named.join(F.broadcast(highest), "b").select("a", "b", "code", "count", (F.col("count") == F.col("highest")).alias("best"))  # a row for each piece of a vocabulary


def _sums(links: DataFrame) -> DataFrame:
    times = F.col("times").cast("long")
    return links.groupBy("row").agg(F.sum(F.when(F.col("best"), times).otherwise(0)).alias("n_best"), F.sum(times * F.col("count")).alias("count_sum"))


def alignment(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, memo: int = MEMO_WORDS, pairs: int = PAIRS) -> DataFrame:
    """How the tokens of each row of ``docs`` (doc_id, text) align: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    The count of a pair of ids is how many links have it in all rows; n_best are the links whose
    count no pair of the same B id exceeds, count_sum adds the counts of all links. Null and empty
    texts, and those that a tokenizer changes, have no tokens: zeros and an empty digest. Rows that
    repeat a doc_id, or have none, are rows of their own and count as often as they stand. Other
    columns are not read; an empty table gives an empty result.
    """
    rows = cut(aligned(docs, a_path, b_path, memo))
    n_b = _pieces(vocabularies(a_path, b_path)[1])
    told = cut(pair_counts(rows, n_b).select("code", "count", "best"))
    n_pairs, n_links = told.agg(F.count("*"), F.coalesce(F.sum("count"), F.lit(0))).first()
    # No more than ``pairs`` pairs can each have more than this share of all links.
    share = 0 if n_pairs <= pairs else n_links // pairs
    links, frequent = _links(rows), F.broadcast(told.where(F.col("count") > share))
    sums = _sums(links.join(frequent, "code"))
    if share:
        rare = told.where(F.col("count") <= share)  # none of them has so many links that it would fill a task
        sums = sums.unionByName(_sums(links.join(frequent, "code", "left_anti").join(rare, "code"))).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_best", "count_sum")]
    return rows.drop("codes", "times").join(sums, "row", "left").select("doc_id", *COUNTS, *zero, "groups_sha256")


def _pieces(path: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path).get_piece_size()
