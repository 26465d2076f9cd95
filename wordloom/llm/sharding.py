"""Operator 8: size-tiered compaction of immutable shards under a versioned manifest.

Arrivals are appended as small immutable Parquet shards. Shards of similar size form a tier;
whenever a tier has a run of enough shards, they are merged, and so on upwards until files have
the target size. A merge task reads its run shard by shard and writes one file, so nothing is
shuffled and memory holds a batch at a time. The list of live shards is a table of its own. A
commit writes a version file under another name and then moves it to the next version's number,
which succeeds for one writer only: readers see a whole version or the one before, and a writer
that dies in between leaves a file that nobody reads. That needs a store in which such a move is
one step that fails if the name is taken: HDFS and local or mounted POSIX folders are; plain
object stores are not. Old shards are removed by ``vacuum`` once no kept version names them.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import new_dir, open_fs, unused

TARGET_BYTES = 128 << 20
FAN_IN = 4
CODEC = "zstd"
#: Up to so many shards are read by Spark's own reader, whose driver holds the list of files; more are read from the manifest, a task for each part of it.
LISTED_SHARDS = 20_000
#: Files younger than this may belong to a writer that has not committed yet; ``vacuum`` leaves them alone.
GRACE_SECONDS = 24 * 3600
SHARD_DDL = "path string, bytes long, n_rows long, tier int"
SHARD = pa.schema([("path", pa.string()), ("bytes", pa.int64()), ("n_rows", pa.int64()), ("tier", pa.int32())])


class ConcurrentCommit(RuntimeError):
    """Another writer has committed the version."""


class ShardTable:
    """A table of Parquet shards under ``folder``, with manifest tables and version files."""

    def __init__(self, spark: SparkSession, folder: str, target_bytes: int = TARGET_BYTES, fan_in: int = FAN_IN):
        self.spark, self.folder, self.target, self.fan_in = spark, folder.rstrip("/"), target_bytes, fan_in

    # Versions: a file each, named by number; it holds its manifest table's name and the rows' schema.

    def _fs(self, path: str):
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        where = hadoop.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def versions(self) -> list[int]:
        fs, where = self._fs(f"{self.folder}/versions")
        if not fs.exists(where):
            return []
        return sorted(int(s.getPath().getName()) for s in fs.listStatus(where) if s.getPath().getName().isdigit())

    def last(self) -> int:
        """The last version; 0 before the first commit."""
        return (self.versions() or [0])[-1]

    def _version(self, version: int) -> tuple[str, str]:
        fs, where = self._fs(f"{self.folder}/versions/{version:012d}")
        stream = fs.open(where)
        name, schema = bytes(b & 255 for b in stream.readAllBytes()).decode().split("\n")
        stream.close()
        return name, schema

    def manifest(self, version: int | None = None) -> DataFrame:
        """The live shards of a version: path, bytes, n_rows, tier."""
        version = self.last() if version is None else version
        if version == 0:
            return self.spark.createDataFrame([], SHARD_DDL)
        return self.spark.read.schema(SHARD_DDL).parquet(f"{self.folder}/{self._version(version)[0]}")

    def _commit(self, shards: DataFrame, after: int, schema: str) -> int:
        """Make ``shards`` the live ones, if ``after`` is still the last version."""
        name = f"manifests/{uuid.uuid4().hex}"
        shards.select("path", "bytes", "n_rows", "tier").write.parquet(f"{self.folder}/{name}")
        number = f"{self.folder}/versions/{after + 1:012d}"
        fs, fresh = self._fs(f"{self.folder}/versions/.{uuid.uuid4().hex}")
        stream = fs.create(fresh, False)
        stream.write(bytearray(f"{name}\n{schema}".encode()))
        stream.close()
        try:
            self._move(fresh, number)
        except Exception as error:
            if after + 1 in self.versions():
                raise ConcurrentCommit(f"version {after + 1} exists") from error
            raise
        finally:
            fs.delete(fresh, False)
        return after + 1

    def _move(self, source, target: str) -> None:
        """Give a file its name in one step, or fail if the name is taken."""
        fs, where = self._fs(target)
        if fs.getUri().getScheme() == "file":
            # A rename would replace the other file there; a link never does.
            os.link(source.toUri().getPath(), where.toUri().getPath())
            return
        self._rename(source, where)

    def _rename(self, source, target) -> None:
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        kind = getattr(hadoop, "Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(kind, 1)
        options[0] = kind.NONE
        hadoop.FileContext.getFileContext(target.toUri(), self.spark._jsc.hadoopConfiguration()).rename(source, target, options)

    # Writing

    @property
    def tier(self):
        """Tier of a number of bytes: 0 near the target size and above, one more for each factor of the fan-in below."""
        target, fan_in = self.target, self.fan_in

        def tier(n_bytes: int) -> int:
            t, size = 0, target
            while n_bytes < size * 0.75 and t < 12:
                size //= fan_in
                t += 1
            return t

        return tier

    @staticmethod
    def _writer(folder: str):
        fs, root = open_fs(folder)
        fs.create_dir(root, recursive=True)
        name = f"shard-{uuid.uuid4().hex}.parquet"
        return fs, f"{folder}/{name}", f"{root}/{name}"

    def append(self, rows: DataFrame, arrival: str | None = None) -> int:
        """Add ``rows``; each partition writes one shard, or one for each value of ``arrival``."""
        after, folder, tier = self.last(), f"{self.folder}/data", self.tier
        writer, at = self._writer, None if arrival is None else rows.columns.index(arrival)

        def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            import pyarrow.parquet as pq

            opened: dict = {}
            for batch in batches:
                parts = {None: batch}
                if at is not None:
                    values = batch.column(at)
                    parts = {v: batch.filter(pc.equal(values, v) if v is not None else values.is_null()) for v in set(values.to_pylist())}
                for value, part in parts.items():
                    if not part.num_rows:
                        continue
                    if value not in opened:
                        fs, path, name = writer(folder)
                        sink = fs.open_output_stream(name)
                        opened[value] = [pq.ParquetWriter(sink, part.schema, compression=CODEC), sink, path, 0]
                    opened[value][0].write_batch(part)
                    opened[value][3] += part.num_rows
            out = []
            for file, sink, path, n in opened.values():
                file.close()
                size = sink.tell()
                sink.close()
                out.append((path, size, n, tier(size)))
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 4, SHARD.types)], schema=SHARD)

        # The shard list is written before it is used, so that no second run of the tasks can add other files.
        fresh = self._pinned(rows.mapInArrow(write, SHARD_DDL))
        return self._commit(self.manifest(after).unionByName(fresh), after, rows.schema.json())

    def _pinned(self, shards: DataFrame) -> DataFrame:
        name = f"{self.folder}/pending/{uuid.uuid4().hex}"
        shards.write.parquet(name)
        return self.spark.read.schema(SHARD_DDL).parquet(name)

    def runs(self, shards: DataFrame) -> DataFrame:
        """path, tier and run of the shards to merge: runs of one tier up to the target size.

        Runs are cut along the cumulated bytes of each tier; a run must have ``fan_in`` shards.
        """
        small = shards.where("tier > 0")
        totals = small.groupBy("tier").agg(F.sum("bytes").alias("total"))  # a row a tier
        small = small.join(F.broadcast(totals), "tier").withColumn("slot", F.pmod(F.xxhash64("path"), F.lit(16)))
        dealt = Window.partitionBy("tier", "slot").orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
        # Slots spread a large tier over tasks; a tier that makes up one file or less stays together.
        slot = F.when(F.col("total") > 64 * self.target, F.col("slot")).otherwise(F.lit(-1))
        small = small.withColumn("slot", slot).withColumn("before", F.coalesce(F.sum("bytes").over(dealt), F.lit(0)))
        run = small.withColumn("run", F.floor(F.col("before") / self.target))
        n = F.count("*").over(Window.partitionBy("tier", "slot", "run"))
        return run.withColumn("n", n).where(F.col("n") >= self.fan_in).select("path", "tier", F.concat_ws("-", "tier", "slot", "run").alias("run"))

    def compact(self) -> int | None:
        """Merge the runs there are and commit; None if there is nothing to merge."""
        after, folder, tier = self.last(), f"{self.folder}/data", self.tier
        if not after:
            return None
        live = self.manifest(after)
        runs = self._planned(live)
        n_runs = runs.select("run").distinct().count()
        if not n_runs:
            return None
        writer = self._writer

        def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            import pyarrow.parquet as pq

            run = file = sink = path = None
            rows = 0

            def done():
                file.close()
                size = sink.tell()
                sink.close()
                return pa.record_batch([pa.array([x], t) for x, t in zip((path, size, rows, tier(size)), SHARD.types)], schema=SHARD)

            for batch in batches:
                for source, mine in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    if file is not None and mine != run:
                        yield done()
                        file = None
                    fs, name = open_fs(source)
                    with fs.open_input_file(name) as opened:
                        reader = pq.ParquetFile(opened)
                        if file is None:
                            out, path, target = writer(folder)
                            sink, run, rows = out.open_output_stream(target), mine, 0
                            file = pq.ParquetWriter(sink, reader.schema_arrow, compression=CODEC)
                        for part in reader.iter_batches(batch_size=8192):
                            file.write_batch(part)
                            rows += part.num_rows
            if file is not None:
                yield done()

        # A task for each run: its rows are few, but each stands for a shard to be read.
        ordered = runs.select("path", "run").repartitionByRange(n_runs, "run").sortWithinPartitions("run", "path")
        merged = self._pinned(ordered.mapInArrow(merge, SHARD_DDL))
        kept = live.join(runs.select("path"), "path", "left_anti")
        return self._commit(kept.unionByName(merged), after, self._version(after)[1])

    def _planned(self, live: DataFrame) -> DataFrame:
        name = f"{self.folder}/pending/{uuid.uuid4().hex}"
        self.runs(live).write.parquet(name)
        return self.spark.read.schema("path string, tier int, run string").parquet(name)

    def settle(self, grace_seconds: float = GRACE_SECONDS) -> int:
        """Compact until no run is left; returns the last version. Each round leaves fewer shards, so it ends."""
        while self.compact() is not None:
            self.vacuum(grace_seconds=grace_seconds)
        return self.last()

    def vacuum(self, keep: int = 1, grace_seconds: float = GRACE_SECONDS) -> None:
        """Delete versions before the last ``keep``, and what those left don't name, if older than the grace time: data files, manifests, pending lists."""
        kept = None
        for v in self.versions()[-keep:]:
            paths = self.manifest(v).select("path")
            kept = paths if kept is None else kept.union(paths)
        if kept is None:
            return
        for v in self.versions()[:-keep]:
            self._drop_old(f"versions/{v:012d}", grace_seconds)
        named = {self._version(v)[0].rpartition("/")[2] for v in self.versions()[-keep:]}
        for kind in ("manifests", "pending"):
            fs, where = self._fs(f"{self.folder}/{kind}")
            for entry in fs.listStatus(where) if fs.exists(where) else ():
                if entry.getPath().getName() not in named:
                    self._drop_old(f"{kind}/{entry.getPath().getName()}", grace_seconds)
        fs, where = self._fs(f"{self.folder}/data")
        if not fs.exists(where):
            return
        listed = self.spark.read.format("binaryFile").load(f"{self.folder}/data").where(F.col("modificationTime") <= F.current_timestamp() - F.make_dt_interval(secs=F.lit(grace_seconds))).select(F.col("path").alias("found"))
        name = F.regexp_extract("found", "[^/]+$", 0)
        gone = listed.select(name.alias("name")).join(kept.select(F.regexp_extract("path", "[^/]+$", 0).alias("name")).distinct(), "name", "left_anti")
        folder = f"{self.folder}/data"

        def delete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            fs, root = open_fs(folder)
            n = 0
            for batch in batches:
                for x in batch.column(0).to_pylist():
                    try:
                        fs.delete_file(f"{root}/{x}")
                        n += 1
                    except FileNotFoundError:
                        pass  # an earlier attempt of this task has deleted it
            yield pa.record_batch([pa.array([n], pa.int64())], names=["n"])

        gone.mapInArrow(delete, "n long").agg(F.sum("n")).collect()

    def _drop_old(self, name: str, grace_seconds: float) -> None:
        fs, where = self._fs(f"{self.folder}/{name}")
        if time.time() - fs.getFileStatus(where).getModificationTime() / 1000 >= grace_seconds:
            fs.delete(where, True)

    # Reading

    def read(self, version: int | None = None, columns: list[str] | None = None) -> DataFrame:
        """The rows of a version's shards, whole or cut down to ``columns``.

        Up to LISTED_SHARDS shards, Spark's reader takes the list of files (and prunes by it what
        a query doesn't need); beyond, tasks read the shards that their part of the manifest names.
        """
        version = self.last() if version is None else version
        if version == 0:
            raise ValueError("nothing has been appended")
        schema = T.StructType.fromJson(json.loads(self._version(version)[1]))
        names = schema.fieldNames() if columns is None else columns
        wanted = T.StructType([schema[c] for c in names])
        shards = self.manifest(version)
        n = shards.count()
        if not n:
            return self.spark.createDataFrame([], wanted)
        if n <= LISTED_SHARDS:
            paths = [r["path"] for r in shards.select("path").collect()]
            return self.spark.read.schema(wanted).parquet(*paths)

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            import pyarrow.parquet as pq

            for batch in batches:
                for path in batch.column(0).to_pylist():
                    fs, name = open_fs(path)
                    with fs.open_input_file(name) as opened:
                        for part in pq.ParquetFile(opened).iter_batches(batch_size=8192, columns=names):
                            yield part.select(names)

        tasks = max(-(-shards.agg(F.sum("bytes")).first()[0] // self.target), 1)
        return shards.select("path").repartition(tasks).mapInArrow(read, wanted)


def compacted(spark: SparkSession, rows: DataFrame, arrivals: int = 8, key: str = "doc_id") -> DataFrame:
    """``rows`` after they have been appended as so many arrivals, compacted, and read back.

    The rows come back as they were, whatever they hold: nulls, repeats and any columns. An
    empty table comes back empty. A row's arrival is a hash of its key.
    """
    table = ShardTable(spark, new_dir(spark, "shards"))
    arrival = unused(rows.columns, "_arrival")
    table.append(rows.withColumn(arrival, F.pmod(F.xxhash64(key), F.lit(arrivals))), arrival)
    table.settle(grace_seconds=0)  # nobody else writes to this table
    return table.read().drop(arrival)


def oracle() -> str:
    return """
SELECT doc_id, lang, source, n_chars, octet_length(encode(text))::BIGINT AS n_bytes, sha256(text) AS text_sha256
FROM documents"""
