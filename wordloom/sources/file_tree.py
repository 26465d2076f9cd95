"""Digests of files folded into digests of folders up to a root, and drift found by going down where they differ."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import table_digest
from .storage import fresh_folder

#: What Spark puts into the names of the files it writes; without it, two runs name their files alike.
RUN_PART = r"-[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}"
NODES = "path string, parent string, depth int, kind string, digest string"


def leaves(spark: SparkSession, folder: str) -> DataFrame:
    """The files under a folder, read and hashed where they lie: path in the folder, parent, depth, kind and digest.

    Marker files (names that begin with ``_`` or ``.``) are left out, and so is the part of a name that tells one of Spark's runs from another.
    """
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    root = where.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(where).toString()
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    path = F.regexp_replace(F.expr(f"substring(path, {len(root) + 2})"), RUN_PART, "")
    told = files.select(path.alias("path"), F.lit("file").alias("kind"), F.sha2("content", 256).alias("digest"))
    return told.select("path", F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("parent"), F.size(F.split("path", "/")).alias("depth"), "kind", "digest")


def tree(files: DataFrame) -> DataFrame:
    """``leaves`` and their folders up to the root (the path ''). A folder's digest is that of the names, kinds and digests in it, whatever their order.

    A folder of very many files is summed in parts, never gathered.
    """
    folder = fresh_folder(files.sparkSession, "tree")
    read = lambda: files.sparkSession.read.schema(NODES).option("recursiveFileLookup", "true").parquet(folder)
    files.write.parquet(f"{folder}/files")
    deepest = read().agg(F.max("depth")).first()[0] or 0
    for depth in range(deepest, 0, -1):
        entry = F.sha2(F.concat_ws("|", F.regexp_extract("path", "[^/]*$", 0), "kind", "digest"), 256)
        above = read().where(F.col("depth") == depth).groupBy("parent").agg(table_digest(entry).alias("digest"))
        up = above.select(F.col("parent").alias("path"), F.regexp_extract("parent", "^(.*)/[^/]*$", 1).alias("parent"), F.lit(depth - 1).alias("depth"), F.lit("folder").alias("kind"), "digest")
        up.write.parquet(f"{folder}/{depth - 1}")
    return read()


def drift(frozen: DataFrame, now: DataFrame) -> DataFrame:
    """(path, kind, drift) of what is missing, added or changed in ``now``; only folders that differ are gone into."""
    spark = frozen.sparkSession
    folder = fresh_folder(spark, "drift")
    deepest = max(x.agg(F.coalesce(F.max("depth"), F.lit(0))).first()[0] for x in (frozen, now))
    read = lambda: spark.read.schema("path string, kind string, drift string").option("recursiveFileLookup", "true").parquet(folder)
    spark.createDataFrame([], "path string, kind string, drift string").write.parquet(f"{folder}/none")
    for depth in range(deepest + 1):
        sides = [x.where(F.col("depth") == depth) for x in (frozen, now)]
        if depth:
            gone_into = spark.read.schema("path string, kind string, drift string").parquet(f"{folder}/{depth - 1}").where("kind = 'folder'").select(F.col("path").alias("parent"))
            sides = [x.join(gone_into, "parent", "left_semi") for x in sides]
        old, new = (x.select("path", "kind", F.col("digest").alias(name)) for x, name in zip(sides, ("old", "new")))
        told = F.when(F.col("new").isNull(), "missing").when(F.col("old").isNull(), "added").otherwise("changed")
        old.join(new, ["path", "kind"], "full").where(~F.col("old").eqNullSafe(F.col("new"))).select("path", "kind", told.alias("drift")).write.parquet(f"{folder}/{depth}")
        if spark.read.parquet(f"{folder}/{depth}").where("kind = 'folder'").isEmpty():
            break
    return read()
