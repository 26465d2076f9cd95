"""Operator 10: quality rules with compression bands.

Besides word and repetition counts, each text is compressed with zstandard, as a whole and in
fixed chunks. Text that shrinks far more than prose is repetitive, text that hardly shrinks is
noise; what counts as either depends on the length, since short inputs compress less.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import tidy

#: (least bytes, lowest ratio, highest ratio): compressed bytes over bytes. The last row whose
#: least length is reached holds. Short texts are not judged: the frame outweighs them.
#: The highest ratios lie between those measured of prose (at most 0.71 from 512 bytes on, 0.60 from
#: 1 KB, 0.53 from 2 KB, 0.48 from 4 KB, 0.44 from 16 KB; random lower-case words 0.66 to 0.58) and of
#: base64 (0.80, 0.77, 0.76, 0.76, 0.75 at least up to the next length).
WHOLE_BANDS = ((0, 0.0, 9.9), (512, 0.15, 0.77), (1024, 0.15, 0.72), (2048, 0.12, 0.68), (4096, 0.12, 0.66), (16384, 0.10, 0.66), (65536, 0.08, 0.66))
CHUNK_BANDS = ((0, 0.0, 9.9), (1024, 0.08, 0.72), (2048, 0.08, 0.68), (4096, 0.05, 0.66))
CHUNK_BYTES = 4096
#: A text goes when more than this share of its chunk bytes lies outside the bands.
BAD_SHARE = 0.5
LEVEL = 3
SYMBOLS = "[#*$%&|<>]"

RESULT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_words", T.LongType()),
        T.StructField("word_chars", T.LongType()),
        T.StructField("n_symbols", T.LongType()),
        T.StructField("n_dup_lines", T.LongType()),
        T.StructField("n_repeat_words", T.LongType()),
        T.StructField("base_failed", T.BooleanType()),
        T.StructField("whole_ratio", T.DoubleType()),
        T.StructField("bad_chunk_share", T.DoubleType()),
        T.StructField("kept", T.BooleanType()),
    ]
)


def outside(n_bytes: int, ratio: float, bands) -> bool:
    """Whether a ratio leaves the band of its length."""
    low, high = next((lo, hi) for least, lo, hi in reversed(bands) if n_bytes >= least)
    return ratio < low or ratio > high


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three words found twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    seen = Counter(windows)
    if len(seen) == len(windows):
        return 0
    count, end = 0, 0
    for i, window in enumerate(windows):
        if seen[window] > 1:
            count += i + 3 - max(i, end)
            end = i + 3
    return count


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split("\n") if x.encode("utf-8", "surrogatepass").split()]
    return len(lines) - len(set(lines))


def compression(raw: bytes, compressor, chunk_bytes: int = CHUNK_BYTES) -> tuple[float, float, bool]:
    """(ratio of the whole, share of bytes in chunks outside their band, verdict: rejected)."""
    if not raw:
        return 0.0, 0.0, False
    whole = len(compressor.compress(raw)) / len(raw)
    bad = 0
    for at in range(0, len(raw), chunk_bytes):
        chunk = raw[at : at + chunk_bytes]
        if outside(len(chunk), len(compressor.compress(chunk)) / len(chunk), CHUNK_BANDS):
            bad += len(chunk)
    share = bad / len(raw)
    return whole, share, outside(len(raw), whole, WHOLE_BANDS) or share > BAD_SHARE


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import re

    import zstandard

    blanks, symbols = re.compile("[\x20\x09-\x0d]"), re.compile(SYMBOLS)
    compressor = zstandard.ZstdCompressor(level=LEVEL)
    schema = pa.schema([(f.name, {"bigint": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}[f.dataType.simpleString()]) for f in RESULT])
    for batch in tidy(batches):
        rows = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py() or ""
            raw = text.encode("utf-8", "surrogatepass")
            words = raw.split()
            n = len(words)
            repeats = repeated_words(words)
            failed = n < 50 or 100 * repeats > 50 * n
            whole, share, rejected = compression(raw, compressor)
            rows.append((doc_id, n, len(text) - len(blanks.findall(text)), len(symbols.findall(text)), repeated_lines(text), repeats, failed, whole, share, not failed and not rejected))
        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * len(schema), schema.types)], schema=schema)


def quality_rules(docs: DataFrame) -> DataFrame:
    """A verdict for each row of ``docs`` (doc_id, text).

    Null and empty texts have no words and fail; repeated rows are judged each by itself;
    columns other than the two are not read. An empty table gives an empty result.
    """
    return docs.select("doc_id", "text").mapInArrow(_judge, RESULT)


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text passes, all their columns as they were.

    The verdict is attached to its row inside one pass, so rows that repeat a doc_id, or have
    none, are each judged by their own text; no join is needed.
    """
    names = docs.columns

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tidy(batches):
            pair = pa.record_batch([batch.column(names.index("doc_id")), batch.column(names.index("text"))], names=["doc_id", "text"])
            for verdict in _judge(iter([pair])):
                yield batch.filter(verdict.column(RESULT.fieldNames().index("kept")))

    return docs.mapInArrow(passing, docs.schema)
