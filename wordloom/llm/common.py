"""Helpers that the corpus operators share: table access and shared storage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named input table, cut down to the columns that are read."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, with its scheme.

    Where a local session has none (unit tests), a temporary folder is set; on a cluster that is an error.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if named is None:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="wordloom-")
    where = sc._jvm.org.apache.hadoop.fs.Path(named)
    named = where.getFileSystem(sc._jsc.hadoopConfiguration()).makeQualified(where).toString()
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named


def new_dir(spark: SparkSession, kind: str) -> str:
    """A fresh folder name under the shared folder, for the files of one run."""
    return f"{shared_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and written as a table in the shared folder; its lineage ends there."""
    spark = df.sparkSession
    name = new_dir(spark, "table")
    df.write.option("compression", "zstd").parquet(name)
    return spark.read.schema(df.schema).parquet(name)


#: Tables are broadcast up to this number of rows and of bytes, counted before.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20


def row_bytes(rows: DataFrame):
    """About how many bytes a row takes: texts and binaries as they are, items of lists by their kind, 8 for anything else."""
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    def size(value, kind):
        if isinstance(kind, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(value), F.lit(0)) + 16
        if isinstance(kind, T.StructType):
            return sum((size(value[f.name], f.dataType) for f in kind.fields), F.lit(8))
        if isinstance(kind, T.ArrayType):
            if isinstance(kind.elementType, (T.StringType, T.BinaryType, T.StructType, T.ArrayType)):
                return F.coalesce(F.aggregate(value, F.lit(16).cast("long"), lambda n, x: n + size(x, kind.elementType)), F.lit(16))
            return F.greatest(F.size(value), F.lit(0)) * 8 + 16
        return F.lit(8)

    return sum((size(F.col(f"`{f.name}`"), f.dataType) for f in rows.schema.fields), F.lit(16)).cast("long")


def small(rows: DataFrame, limit: int = BROADCAST_ROWS, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``rows`` (a written table), marked to be broadcast if they are few and small enough; else Spark shuffles them."""
    from pyspark.sql import functions as F

    n, size = rows.agg(F.count("*"), F.coalesce(F.sum(row_bytes(rows)), F.lit(0))).first()
    return rows.hint("broadcast") if n <= limit and size <= most_bytes else rows


def open_fs(uri: str):
    """(pyarrow file system, path in it) of a URI, for tasks that write or range-read files."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri else uri.replace("file:", "file://", 1))


def tidy(batches):
    """The batches of a task; memory that Arrow keeps for the next ones goes back when a batch is done, as workers live on after it."""
    import pyarrow as pa

    for batch in batches:
        yield batch
        del batch
        pa.default_memory_pool().release_unused()


def ascii_lower(column):
    """A-Z lower-cased; every other character stays as it is."""
    from pyspark.sql import functions as F

    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def unused(columns: list[str], name: str) -> str:
    """``name``, lengthened until no column has it; Spark doesn't tell upper from lower case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name
