"""Operator 4: WARC archives with a two-level capture index.

Pages are written as WARC/1.1 records, each a gzip member of its own, in the partitions in
which they are read. A record whose payload equals that of another one becomes a revisit of it
without the payload. The index sorts the captures by reversed-host URL key into shards of
compressed blocks; each shard ends with its sparse block directory (first key and place of
each block). A lookup finds the shard by the shards' key ranges, the block by binary search in
the directory, reads that range, and then range-reads the records themselves, in file order.

Tasks write under unique names in the shared folder, and a checkpointed manifest names the
files of the attempts that succeeded, so a lost executor costs a rerun and nothing else.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, new_dir, open_fs

DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LEVEL = 4
ARCHIVE_BYTES = 1 << 30
BLOCK_ENTRIES = 512
MAGIC = b"WLCDXIX1"
#: Repeated payloads up to this number are broadcast (about 100 bytes each); more are shuffled.
BROADCAST_ROWS = 100_000
STRETCH = 64 << 20  # bytes of archives that one task reads
READ_AHEAD = 8 << 20
GAP = 256 << 10


def url_key(url: str | None) -> str:
    """Reversed host, then path and query, as ``com,example,www)/path?query``; "-" without a host."""
    try:
        parts = urlsplit((url or "").strip())
        host = (parts.hostname or "").rstrip(".")
        port = f":{parts.port}" if parts.port else ""
    except ValueError:
        host = port = ""
    if not host:
        return "-" + quote(url or "", safe="/:?&=%;,+")
    path = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return ",".join(reversed(host.split("."))) + port + ")" + "".join(c if c > " " else quote(c) for c in path)


def record_name(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, sha1_hex: str, refers_to: int | None, revisit: bool, date: str = DATE) -> bytes:
    """One WARC record, not compressed."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = ["WARC/1.1", "WARC-Type: " + ("revisit" if revisit else "response"), "WARC-Record-ID: " + record_name(page_id), "WARC-Date: " + date]
    if url:
        head.append("WARC-Target-URI: " + quote(url, safe="!#$%&'()*+,/:;=?@[]~"))
    head.append("WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(sha1_hex)).decode())
    if revisit:
        head += ["WARC-Profile: " + PROFILE, "WARC-Refers-To: " + record_name(refers_to)]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _page(name: str) -> int | None:
    number = name.removeprefix("<urn:x-page:").removesuffix(">")
    return int(number) if number else None


def parse(raw: bytes) -> tuple[int | None, int, str, str, int | None, bytes]:
    """(page_id, payload bytes, payload digest, type, refers to, payload) of a record.

    The digest of a payload that is there is checked.
    """
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.partition(b":")[2]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    if fields["warc-type"] == "response" and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"record {fields['warc-record-id']} is damaged")
    refers = _page(fields["warc-refers-to"]) if "warc-refers-to" in fields else None
    return _page(fields["warc-record-id"]), size, digest, fields["warc-type"], refers, payload


ENTRY = pa.schema([("key", pa.string()), ("page_id", pa.int64()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])
ENTRY_DDL = "key string, page_id long, file string, offset long, length long"


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0, date: str = DATE) -> DataFrame:
    """Write ``pages`` (page_id, url, html) and return a capture for each row: key, page_id, file, offset, length.

    Of rows with equal payloads of at least ``least_bytes`` bytes, the one with the largest
    page_id is the response and the others revisit it; rows with that same page_id are all
    responses, and so are equal payloads none of which has a page_id. A null html is empty.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long"), "url", payload.alias("payload"))
    digest = F.sha1("payload").alias("digest")
    sized = rows.where(F.length("payload") >= least_bytes).select("page_id", digest)
    repeats = cut(sized.groupBy("digest").agg(F.count("*").alias("n"), F.max("page_id").alias("keeper")).where("n > 1 AND keeper IS NOT NULL").drop("n"))
    known = rows.select("*", digest)
    n = repeats.count()
    if n == 0:
        known = known.withColumn("keeper", F.lit(None).cast("long"))
    else:
        known = known.join(F.broadcast(repeats) if n <= BROADCAST_ROWS else repeats, "digest", "left")
        known = known.withColumn("keeper", F.when(F.length("payload") >= least_bytes, F.col("keeper")))
    revisit = F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs = sink = None
        path, at = "", 0
        for batch in batches:
            entries = []
            columns = [batch.column(i) for i in range(6)]
            for page_id, url, body, sha1_hex, keeper, again in zip(*columns):
                if sink is None or at >= ARCHIVE_BYTES:
                    if sink is not None:
                        sink.close()
                    fs, root = open_fs(folder)
                    fs.create_dir(root, recursive=True)
                    name, at = f"pages-{uuid.uuid4().hex}.warc.gz", 0
                    path, sink = f"{folder}/{name}", fs.open_output_stream(f"{root}/{name}", compression=None)
                page_id, url = page_id.as_py(), url.as_py()
                raw = record(page_id, url, body.as_py(), sha1_hex.as_py(), keeper.as_py(), again.as_py(), date)
                packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                member = packer.compress(raw) + packer.flush()
                sink.write(member)
                entries.append((url_key(url), page_id, path, at, len(member)))
                at += len(member)
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*entries) if entries else [[]] * 5, ENTRY.types)], schema=ENTRY)
        if sink is not None:
            sink.close()

    return cut(known.select("page_id", "url", "payload", "digest", "keeper", revisit.alias("again")).mapInArrow(write, ENTRY_DDL))


def build_index(entries: DataFrame, folder: str, block_entries: int = BLOCK_ENTRIES) -> DataFrame:
    """Write the index shards; a row for each: shard, first_key, last_key, n_entries."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sink, path, at, n = None, "", 0, 0
        lines: list[str] = []
        directory: list[tuple[str, int, int]] = []
        first = last = ""

        def flush():
            nonlocal at
            block = zlib.compress("".join(lines).encode(), 6)
            directory.append((lines[0].split("\t", 1)[0], at, len(block)))
            sink.write(block)
            at += len(block)
            lines.clear()

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if sink is None:
                    fs, root = open_fs(folder)
                    fs.create_dir(root, recursive=True)
                    name = f"index-{uuid.uuid4().hex}.cdx"
                    path, sink, first = f"{folder}/{name}", fs.open_output_stream(f"{root}/{name}", compression=None), row[0]
                last = row[0]
                n += 1
                lines.append("\t".join("" if x is None else str(x) for x in row) + "\n")
                if len(lines) == block_entries:
                    flush()
        if sink is not None:
            if lines:
                flush()
            footer = zlib.compress(json.dumps(directory).encode(), 6)
            sink.write(footer + struct.pack("<Q", len(footer)) + MAGIC)
            sink.close()
            yield pa.RecordBatch.from_pydict({"shard": [path], "first_key": [first], "last_key": [last], "n_entries": [n]})

    ordered = entries.repartitionByRange("key", "page_id").sortWithinPartitions("key", "page_id")
    return cut(ordered.mapInArrow(write, "shard string, first_key string, last_key string, n_entries long"))


class Shard:
    """An open index shard; keeps the block that was read last."""

    def __init__(self, path: str):
        fs, name = open_fs(path)
        self.source = fs.open_input_file(name)
        size = self.source.size()
        tail = self.source.read_at(16, size - 16)
        if tail[8:] != MAGIC:
            raise ValueError(f"{path} is not an index shard")
        length = struct.unpack("<Q", tail[:8])[0]
        self.directory = json.loads(zlib.decompress(self.source.read_at(length, size - 16 - length)))
        self.firsts = [x[0] for x in self.directory]
        self.held, self.rows, self.keys = -1, [], []

    def _block(self, i: int) -> None:
        if i != self.held:
            _, at, length = self.directory[i]
            self.rows = [x.split("\t") for x in zlib.decompress(self.source.read_at(length, at)).decode().removesuffix("\n").split("\n")]
            self.keys, self.held = [x[0] for x in self.rows], i

    def find(self, key: str) -> Iterator[list[str]]:
        """All captures of a key, which may run over several blocks."""
        at = max(bisect_left(self.firsts, key) - 1, 0)
        while at < len(self.firsts) and self.firsts[at] <= key:
            self._block(at)
            yield from self.rows[bisect_left(self.keys, key) : bisect_right(self.keys, key)]
            at += 1


def lookup(shards: DataFrame, urls: DataFrame) -> DataFrame:
    """The captures of each distinct url in the first column of ``urls``."""
    # One row a shard, and there are no more shards than shuffle partitions.
    ranges = sorted((r["first_key"], r["last_key"], r["shard"]) for r in shards.collect())

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts = [r[0] for r in ranges]
        for batch in batches:
            keys, where = [], []
            for url in batch.column(0).to_pylist():
                key = url_key(url)
                at = bisect_right(firsts, key) - 1
                while at >= 0 and ranges[at][1] >= key:
                    keys.append(key)
                    where.append(ranges[at][2])
                    at -= 1
            yield pa.record_batch([pa.array(keys, pa.string()), pa.array(where, pa.string())], names=["key", "shard"])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, shard = None, None
        for batch in batches:
            found = []
            for key, where in zip(*(c.to_pylist() for c in batch.columns)):
                if where != path:
                    path, shard = where, Shard(where)
                for _, page_id, file, offset, length in shard.find(key):
                    found.append((key, int(page_id) if page_id else None, file, int(offset), int(length)))
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*found) if found else [[]] * 5, ENTRY.types)], schema=ENTRY)

    routed = urls.select(urls.columns[0]).distinct().mapInArrow(route, "key string, shard string").distinct()
    return routed.repartition("shard").sortWithinPartitions("shard", "key").mapInArrow(find, ENTRY_DDL)


RECORD_DDL = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_records(captures: DataFrame, payloads: bool = False, written: bool = False) -> DataFrame:
    """The records of ``captures`` by range reads; neighbours in a file share a read. ``written``: the captures are a table already."""
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    width = 6 if payloads else 5

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, path = None, None
        for batch in batches:
            rows = list(zip(*(c.to_pylist() for c in batch.columns)))
            out, i = [], 0
            while i < len(rows):
                file, begin, length = rows[i]
                end, j = begin + length, i + 1
                while j < len(rows) and rows[j][0] == file and rows[j][1] - end <= GAP and rows[j][1] + rows[j][2] - begin <= READ_AHEAD:
                    end = max(end, rows[j][1] + rows[j][2])
                    j += 1
                if file != path:
                    fs, name = open_fs(file)
                    path, source = file, fs.open_input_file(name)
                raw = source.read_at(end - begin, begin)
                for _, at, size in rows[i:j]:
                    out.append(parse(zlib.decompress(raw[at - begin : at - begin + size], 31))[:width])
                i = j
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * width, types)], names=names[:width])

    # A capture is a small row that stands for much reading, so the bytes to be read set the number of tasks.
    captures = captures.select("file", "offset", "length")
    captures = captures if written else cut(captures)
    n_bytes = captures.agg(F.sum("length")).first()[0] or 0
    tasks = max(-(-n_bytes // STRETCH), captures.sparkSession.sparkContext.defaultParallelism)
    ordered = captures.repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset")
    return ordered.mapInArrow(read, RECORD_DDL + (", payload binary" if payloads else ""))


def archive_and_read(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write ``pages``, index the captures, look every url up and read all records back.

    A row for each page: page_id, payload_bytes, payload_digest, record_type, refers_to. Null
    urls are filed under one key, repeated rows are records of their own, other columns are not
    read, and an empty table gives an empty result. An index that doesn't give back as many
    captures as were written is an error.
    """
    pages = pages.select("page_id", "url", "html")
    folder = new_dir(spark, "warc")
    entries = write_archives(pages, folder)
    captures = cut(lookup(build_index(entries, folder), pages.select("url")))
    written, found = entries.count(), captures.count()
    if written != found:
        raise RuntimeError(f"{written} captures were written, and the index gives {found}")
    return read_records(captures, written=True)


def oracle() -> str:
    """The same rows by DuckDB; base32 comes from the digest's bits, five at a time."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    bits = "array_to_string(list_transform(range(1, 41), lambda i: lpad(bin(('0x' || sha1(h)[i])::INT), 4, '0')), '')"
    return f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes, {bits} AS bits FROM p),
e AS (SELECT page_id, payload_bytes, array_to_string(list_transform(range(0, 32), lambda i: '{letters}'[list_reduce(list_transform(range(1, 6), lambda j: bits[i * 5 + j]::INT), lambda a, b: a * 2 + b) + 1]), '') AS payload_digest FROM d),
f AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS keeper FROM e)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> keeper THEN keeper END AS refers_to
FROM f"""
