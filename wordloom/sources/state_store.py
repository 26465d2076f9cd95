"""A keyed table of states with versions: loaded whole, checked, and saved by compare-and-swap.

A version is one small file, named by its number, that lists data folders: a base and the changes
since. It gets its name in one step that fails if the name is taken, so of two writers who have
loaded the same version one commits, and a writer who dies before that step leaves the last version
as it was. Data folders never change once written; what no version names is vacuumed.

A save is checked before anything is committed: keys, states and histories by themselves, and each
history against the stored one, which it must begin with. One unsound row refuses the whole save.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import canonical, table_digest
from ..operators.lifecycle import TRANSITIONS

#: After so many folders of changes a save writes a new base.
MAX_CHANGES = 8
GRACE_SECONDS = 24 * 3600.0


class StaleState(RuntimeError):
    """The version that was loaded is not the last one any more."""


class UnsoundState(ValueError):
    """Rows that break an invariant; ``counts`` has how many by rule."""

    def __init__(self, counts: dict[str, int], sample: list):
        super().__init__(f"{counts}, such as {sample}")
        self.counts = counts


class Files:
    """Small files in a store that driver and executors share, by Hadoop's file system."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def at(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def names(self, folder: str) -> list[tuple[str, float]]:
        """(name, seconds since it was changed) of what a folder holds; hidden files left out."""
        fs, where = self.at(folder)
        if not fs.exists(where):
            return []
        listed = [(s.getPath().getName(), time.time() - s.getModificationTime() / 1000) for s in fs.listStatus(where)]
        return sorted(x for x in listed if not x[0].startswith("."))

    def read(self, path: str) -> str:
        fs, where = self.at(path)
        stream = fs.open(where)
        try:
            return bytes(b & 255 for b in stream.readAllBytes()).decode()
        finally:
            stream.close()

    def create(self, path: str, text: str) -> bool:
        """Write a file that appears whole; False if there is one of that name."""
        folder, _, name = path.rpartition("/")
        fs, fresh = self.at(f"{folder}/.{name}-{uuid.uuid4().hex}")
        stream = fs.create(fresh, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        where = self.at(path)[1]
        try:
            if fs.getUri().getScheme() == "file":
                os.link(fresh.toUri().getPath(), where.toUri().getPath())  # a rename would replace the other file
            else:
                self._rename(fresh, where)
        except Exception:
            if fs.exists(where):
                return False
            raise
        finally:
            fs.delete(fresh, False)
        return True

    def _rename(self, source, target) -> None:
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        options = self.spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
        options[0] = getattr(hadoop, "Options$Rename").NONE
        hadoop.FileContext.getFileContext(source.toUri(), self.spark._jsc.hadoopConfiguration()).rename(source, target, options)

    def delete(self, folder: str) -> None:
        fs, where = self.at(folder)
        fs.delete(where, True)


def history_rules(state: str = "state", history: str = "history", first: Sequence[str] = ("GENERATED",), transitions: Mapping[str, Sequence[str]] = TRANSITIONS) -> dict[str, Column]:
    """What is wrong with a row's state and history (an array of states), by rule."""
    known = F.array(*map(F.lit, transitions))
    table = F.create_map(*[x for s, f in transitions.items() for x in (F.lit(s), F.array(*map(F.lit, f)).cast("array<string>"))])
    past = F.col(history)
    pairs = F.zip_with(F.slice(past, 1, F.greatest(F.size(past) - 1, F.lit(0))), F.slice(past, 2, F.greatest(F.size(past) - 1, F.lit(0))), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    none = past.isNull() | (F.size(past) <= 0)
    return {
        "unknown_state": F.col(state).isNull() | ~F.array_contains(known, F.col(state)),
        "no_history": none,
        "unknown_in_history": ~none & F.exists(past, lambda s: s.isNull() | ~F.array_contains(known, s)),
        "history_starts_elsewhere": ~none & ~F.coalesce(F.get(past, F.lit(0)).isin(*first), F.lit(False)),
        "history_ends_elsewhere": ~none & ~F.element_at(past, -1).eqNullSafe(F.col(state)),
        "illegal_step": ~none & F.exists(pairs, lambda p: F.array_contains(known, p["a"]) & ~F.array_contains(F.coalesce(table[p["a"]], F.array().cast("array<string>")), p["b"])),
    }


class StateStore:
    """States by key under ``folder``, with the columns ``schema``; ``history`` is an array of states."""

    def __init__(self, spark: SparkSession, folder: str, schema: str, key: str, state: str = "state", history: str = "history", rules: Mapping[str, Column] | None = None):
        self.spark, self.folder, self.key, self.history = spark, folder.rstrip("/"), key, history
        self.schema = T.StructType.fromDDL(schema)
        self.rules = history_rules(state, history) if rules is None else dict(rules)
        self.files = Files(spark)

    def versions(self) -> list[int]:
        return [int(name) for name, _ in self.files.names(f"{self.folder}/versions") if name.isdigit()]

    def last(self) -> int:
        """The last version; 0 before the first save."""
        return (self.versions() or [0])[-1]

    def _listed(self, version: int) -> list[str]:
        """The data folders of a version, oldest first."""
        return json.loads(self.files.read(f"{self.folder}/versions/{version:012d}"))["data"] if version else []

    def _merged(self, folders: list[str]) -> DataFrame:
        """The newest row of each key. The base meets only the keys that have changed.

        Joins of this table are merge joins: files of keys are so small for their rows that Spark
        would broadcast millions of keys, which all pass through the driver.
        """
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        read = lambda name: self.spark.read.schema(self.schema).parquet(f"{self.folder}/data/{name}")
        base, changes = read(folders[0]), None
        for n, name in enumerate(folders[1:]):
            rows = read(name).select(self.key, F.struct(F.lit(n).alias("n"), F.struct("*").alias("row")).alias("held"))
            changes = rows if changes is None else changes.unionByName(rows)
        if changes is None:
            return base
        newest = changes.groupBy(self.key).agg(F.max_by("held.row", "held.n").alias("row"))
        return base.join(newest.select(self.key).hint("merge"), self.key, "left_anti").select(self.schema.names).unionByName(newest.select("row.*"))

    def load(self, version: int | None = None) -> tuple[DataFrame, int]:
        """(rows, version): the last one, or the one that is asked for."""
        version = self.last() if version is None else version
        return self._merged(self._listed(version)), version

    def fingerprint(self, version: int | None = None) -> str:
        """A digest of a version's rows, to which batches derived from it are bound."""
        rows = self.load(version)[0]
        return rows.select(canonical(*self.schema.names).alias("d")).agg(table_digest(F.substring("d", 8, 64))).first()[0]

    def broken(self, changes: DataFrame, seen: int) -> DataFrame:
        """The key and the broken rules of each row of ``changes`` that can't be saved on top of version ``seen``."""
        stored = self.load(seen)[0].select(F.col(self.key).alias("_key"), F.col(self.history).alias("_past"))
        own = changes.select(self.schema.names).withColumn("_times", F.count("*").over(Window.partitionBy(self.key)))
        told = own.join(stored.hint("merge"), F.col(self.key) == F.col("_key"), "left")
        past, held = F.col(self.history), F.col("_past")
        rules = {"no_key": F.col(self.key).isNull(), "repeated_key": F.col(self.key).isNotNull() & (F.col("_times") > 1), **self.rules}
        rules["history_rewritten"] = held.isNotNull() & ~F.slice(past, 1, F.greatest(F.size(held), F.lit(1))).eqNullSafe(held)
        found = F.array_compact(F.array(*[F.when(F.coalesce(rule, F.lit(True)), F.lit(name)) for name, rule in rules.items()]))
        return told.select(self.key, found.alias("rules")).where(F.size("rules") > 0)

    def save(self, changes: DataFrame, seen: int) -> int:
        """Commit new and changed rows on top of version ``seen``; gives the new version.

        Raises StaleState if another version has come since, UnsoundState if a row breaks a rule.
        Saving no rows is a version too.
        """
        if self.last() != seen:
            raise StaleState(f"version {seen} was loaded, {self.last()} is the last")
        name = uuid.uuid4().hex
        changes.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema]).write.parquet(f"{self.folder}/data/{name}")
        written = self.spark.read.schema(self.schema).parquet(f"{self.folder}/data/{name}")  # what is checked is what was written
        wrong = self.broken(written, seen)
        counts = {r["rule"]: r["n"] for r in wrong.select(F.explode("rules").alias("rule")).groupBy("rule").agg(F.count("*").alias("n")).collect()}
        if counts:
            sample = [tuple(r) for r in wrong.limit(3).collect()]
            self.files.delete(f"{self.folder}/data/{name}")
            raise UnsoundState(counts, sample)
        folders = [*self._listed(seen), name]
        if len(folders) > MAX_CHANGES + 1:
            base = uuid.uuid4().hex
            self._merged(folders).write.parquet(f"{self.folder}/data/{base}")
            folders = [base]
        if not self.files.create(f"{self.folder}/versions/{seen + 1:012d}", json.dumps({"data": folders})):
            raise StaleState(f"version {seen + 1} was committed by another writer")
        return seen + 1

    def vacuum(self, keep: int = 2, grace_seconds: float = GRACE_SECONDS) -> int:
        """Delete versions before the last ``keep`` and data that none of those left names, if older than the grace time; gives how many folders went."""
        versions = self.versions()
        for v in versions[:-keep]:
            self.files.delete(f"{self.folder}/versions/{v:012d}")
        named = {name for v in versions[-keep:] for name in self._listed(v)}
        gone = [name for name, age in self.files.names(f"{self.folder}/data") if name not in named and age >= grace_seconds]
        for name in gone:
            self.files.delete(f"{self.folder}/data/{name}")
        return len(gone)
