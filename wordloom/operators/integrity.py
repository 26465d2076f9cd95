"""Bundles of files published whole, verified by their hashes; tables published all or nothing."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def file_hashes(spark: SparkSession, folder: str) -> DataFrame:
    """name and sha256 of each file under a folder, hashed where the files are read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select(F.regexp_extract("path", "[^/]+$", 0).alias("name"), F.concat(F.lit("sha256:"), F.sha2("content", 256)).alias("sha256"))


def publish(tables: dict[str, DataFrame], folder: str, run: str | None = None) -> str:
    """Write tables into a run's folder, each checked off when it is whole, then the manifest, then COMPLETE.

    The run begins with a file IN_PROGRESS that names its tables. With the ``run`` that a lost
    publisher has left, tables that are checked off are kept and the others written anew; a run
    of other tables, or one that is COMPLETE, is refused.
    """
    from ..sources.state_store import Files

    spark = next(iter(tables.values())).sparkSession
    files, run = Files(spark), run or f"{folder.rstrip('/')}/{uuid.uuid4().hex}"
    names = json.dumps(sorted(tables))
    if not files.create(f"{run}/status/IN_PROGRESS", names) and files.read(f"{run}/status/IN_PROGRESS") != names:
        raise ValueError(f"{run} publishes {files.read(f'{run}/status/IN_PROGRESS')}")
    done = {name for name, _ in files.names(f"{run}/status")}
    if "COMPLETE" in done:
        raise ValueError(f"{run} is complete")
    for name, table in tables.items():
        if f"table-{name}" not in done:
            table.write.mode("overwrite").json(f"{run}/data/{name}")
            files.create(f"{run}/status/table-{name}", name)
    file_hashes(spark, f"{run}/data").where("name LIKE 'part-%'").write.mode("overwrite").json(f"{run}/manifest")
    files.create(f"{run}/status/COMPLETE", names)
    return run


def verify(spark: SparkSession, run: str) -> DataFrame:
    """name and fault of every file that is missing, unexpected or changed; a run that isn't COMPLETE has that fault alone."""
    from ..sources.state_store import Files

    if "COMPLETE" not in {name for name, _ in Files(spark).names(f"{run}/status")}:
        return spark.createDataFrame([("COMPLETE", "missing")], "name string, fault string")
    told = spark.read.schema("name string, sha256 string").json(f"{run}/manifest").withColumnRenamed("sha256", "told")
    seen = file_hashes(spark, f"{run}/data").where("name LIKE 'part-%'")
    fault = F.when(F.col("sha256").isNull(), "missing").when(F.col("told").isNull(), "unexpected").when(F.col("told") != F.col("sha256"), "changed")
    return told.join(seen, "name", "full").select("name", fault.alias("fault")).where("fault IS NOT NULL")


def duplicates(rows: DataFrame, *keys: str) -> DataFrame:
    """Keys that stand more than once."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def require_unique(rows: DataFrame, *keys: str) -> DataFrame:
    """``rows``, or an error if a key is missing or repeated; one pass, a row at most comes back."""
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    bad = rows.groupBy(*keys).agg(F.count("*").alias("n")).where((F.col("n") > 1) | missing).take(1)
    if bad:
        raise ValueError(f"key {tuple(bad[0])[: len(keys)]} is missing or repeated")
    return rows


class UnverifiedRun(ValueError):
    """A section whose run is incomplete or changed, or whose items are not sound."""


def verified_union(spark: SparkSession, sections: dict[str, tuple[str, str, str, dict[str, Column]]], key: str) -> DataFrame:
    """The items of several sections' published runs as one table, each run verified before a row of it is read.

    ``sections`` gives by name the run, its table, the table's schema and the columns that make an
    item of it; all sections must make the same columns, ``key`` among them. A run with a fault, a
    section without items, and a key that is null or stands twice in its section are errors; the
    same key in two sections is not. The order of the sections has no effect.
    """
    whole = None
    for name in sorted(sections):
        run, table, schema, columns = sections[name]
        faults = verify(spark, run).limit(5).collect()
        if faults:
            raise UnverifiedRun(f"{name}: {', '.join(f'{r.name} {r.fault}' for r in faults)}")
        items = spark.read.schema(schema).option("mode", "FAILFAST").json(f"{run}/data/{table}").select(F.lit(name).alias("section"), *[c.alias(n) for n, c in sorted(columns.items())])
        whole = items if whole is None else whole.unionByName(items)
    counts = {r["section"]: r["n"] for r in whole.groupBy("section").agg(F.count("*").alias("n")).collect()}  # a row a section
    if empty := sorted(set(sections) - set(counts)):
        raise UnverifiedRun(f"{', '.join(empty)}: no items")
    wrong = whole.groupBy("section", key).agg(F.count("*").alias("n")).where((F.col("n") > 1) | F.col(key).isNull()).take(1)
    if wrong:
        raise UnverifiedRun(f"{wrong[0]['section']}: {key} {wrong[0][key]} is missing or repeated")
    return whole
