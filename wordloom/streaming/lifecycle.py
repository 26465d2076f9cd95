"""Streams over the event table: watermarked counts and per-key state."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.lifecycle import TRANSITIONS
from ..sources.storage import fresh_folder


def events(spark: SparkSession, path: str, files_at_once: int | None = None) -> DataFrame:
    """A stream of the event files (a file, or a folder of them that ends in a slash); ``ts`` becomes a timestamp, as event time needs one."""
    schema = spark.read.parquet(path).schema
    raw = spark.readStream.schema(schema).option("pathGlobFilter", os.path.basename(path) or "*.parquet")
    raw = raw.option("maxFilesPerTrigger", files_at_once) if files_at_once else raw
    return raw.parquet(os.path.dirname(path)).withColumn("ts", F.col("ts").cast("timestamp"))


def run_once(stream: DataFrame, mode: str, folder: str | None = None) -> DataFrame:
    """Process what there is, write it to the shared folder and return the result as a table; a ``folder`` goes on from its last run."""
    spark, folder = stream.sparkSession, folder or fresh_folder(stream.sparkSession, "stream")
    out, seen = f"{folder}/out", f"{folder}/progress"
    if mode == "append":
        writer = stream.writeStream.outputMode("append").format("parquet").option("path", out)
    else:
        # Each batch holds the changed keys; its number tells which row of a key is the last.
        def keep(batch: DataFrame, number: int) -> None:
            batch.withColumn("_batch", F.lit(number)).write.mode("overwrite").parquet(f"{out}/b={number}")

        writer = stream.writeStream.outputMode("update").foreachBatch(keep)
    writer.option("checkpointLocation", seen).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out)


def daily_counts(spark: SparkSession, path: str) -> DataFrame:
    """Counts a day and kind; events more than a day late are let in until the watermark passes them."""
    counted = events(spark, path).withWatermark("ts", "1 day").groupBy(F.window("ts", "1 day"), "event_type").agg(F.count("*").alias("n"))
    rows = run_once(counted.select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "event_type", "n"), "update")
    best = rows.groupBy("day", "event_type").agg(F.max_by("n", "_batch").alias("n"))
    return best.select("day", "event_type", "n")


#: No event is so late; a row of this time closes a stream, and is dropped itself.
CLOSING = "9999-01-01 00:00:00"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STEP = T.StructType([T.StructField(n, t) for n, t in (("user_id", T.LongType()), ("event_id", T.LongType()), ("state", T.StringType()), ("before", T.StringType()), ("step", T.LongType()), ("legal", T.BooleanType()))])


#: Users are dealt into so many buckets, whose rows and state are worked on as tables.
BUCKETS = 1024
LEGAL = frozenset(f"{before}>{after}" for before, followers in TRANSITIONS.items() for after in followers)
WHO = ["no_user", "user_id"]


def _packed(rows: pd.DataFrame) -> bytes:
    sink, table = pa.BufferOutputStream(), pa.Table.from_pandas(rows, preserve_index=False)
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(block: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(bytes(block)).read_pandas()


def told_steps(last: pd.DataFrame, due: pd.DataFrame, idle: int | None = None) -> tuple[pd.DataFrame, pd.DataFrame]:
    """The steps of ``due`` rows of many users, and the last one of each user, from what ``last`` keeps of each."""
    both = pd.concat([last.assign(event_id=0, fresh=False), due.assign(step=0, fresh=True)], ignore_index=True)
    both = both.sort_values([*WHO, "fresh", "at", "event_id", "state"], ignore_index=True)
    begins = (both[WHO] != both[WHO].shift()).any(axis=1)
    if idle is not None:
        begins |= both["at"].diff() > idle
    run = begins.cumsum()
    first = both["step"].where(~both["fresh"], 1).groupby(run).transform("first")
    both["step"] = first + both.groupby(run).cumcount()
    both["before"] = both["state"].shift().astype(object).where(~begins, None)
    both["legal"] = begins | (both["before"].fillna("") + ">" + both["state"]).isin(LEGAL)
    kept = both.drop_duplicates(WHO, keep="last")[[*WHO, "at", "state", "step"]]
    return both[both["fresh"]], kept


class Steps(StatefulProcessor):
    """Steps of each user of a bucket in event time: events wait in state until the watermark has passed them.

    So the steps don't depend on how the events are cut into batches, as long as none is later
    than the watermark allows. With ``idle`` microseconds a user who has been silent for longer
    begins anew, and what is kept of them goes when the watermark tells so. State is kept in
    blocks of many rows, as a call for each row or user costs more than the work itself.
    """

    def __init__(self, idle: int | None = None):
        self.idle = idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "block binary")
        self.last = handle.getValueState("last", "block binary")
        self.timer = handle.getValueState("timer", "at long")

    def _wake(self, at: int | None) -> None:
        """Be called when the watermark has passed ``at`` (microseconds), and at no other time."""
        if self.timer.exists():
            self.handle.deleteTimer(self.timer.get()[0])
            self.timer.clear()
        if at is not None:
            millis = -(-at // 1000)
            self.handle.registerTimer(millis)
            self.timer.update((millis,))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        least = None
        for frame in rows:
            given = frame[[*WHO, "at", "event_id", "state"]].astype({"user_id": "int64", "event_id": "int64", "at": "int64"})
            self.waiting.appendValue((_packed(given),))
            here = int(given["at"].min())
            least = here if least is None else min(least, here)
        millis = self.timer.get()[0] if self.timer.exists() else None
        if millis is None or least < millis * 1000:
            self._wake(least)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        blocks = [_unpacked(block) for (block,) in self.waiting.get()]
        none = pd.DataFrame({"no_user": pd.Series(dtype="bool"), "user_id": pd.Series(dtype="int64"), "at": pd.Series(dtype="int64"), "state": pd.Series(dtype="object")})
        rows = pd.concat(blocks, ignore_index=True) if blocks else none.assign(event_id=pd.Series(dtype="int64"))
        last = _unpacked(self.last.get()[0]) if self.last.exists() else none.assign(step=pd.Series(dtype="int64"))
        due, rest = rows[rows["at"] <= passed], rows[rows["at"] > passed]
        told, kept = told_steps(last, due, self.idle)
        if len(rest):
            self.waiting.put([(_packed(rest),)])
        else:
            self.waiting.clear()
        self.timer.clear()
        if self.idle is not None:
            kept = kept[kept["at"] + self.idle + 1 > passed]
        if len(kept):
            self.last.update((_packed(kept),))
        else:
            self.last.clear()
        ahead = [int(rest["at"].min())] if len(rest) else []
        if self.idle is not None and len(kept):
            ahead.append(int(kept["at"].min()) + self.idle + 1)
        self._wake(min(ahead, default=None))
        users = told["user_id"].astype("Int64").mask(told["no_user"])
        yield told.assign(user_id=users)[STEP.names]

    def close(self) -> None:
        pass


def steps(spark: SparkSession, path: str, state_sql: str, delay: str = "1 day", idle: int | None = None, files_at_once: int | None = None) -> DataFrame:
    """The steps of each user over the event files of ``path``, as ``operators.lifecycle.steps`` has them.

    ``delay`` is how much later than the latest event another may come. When all files are read,
    the stream is closed, so that what still waits is told as well.
    """
    folder = fresh_folder(spark, "steps")
    closing, schema = f"{folder}/closing", spark.read.parquet(path).schema
    spark.createDataFrame([], schema).write.parquet(closing)
    both = events(spark, path, files_at_once).unionByName(events(spark, f"{closing}/"))
    rows = both.withWatermark("ts", delay).where(F.col("ts") < F.lit(CLOSING).cast("timestamp")).select(F.pmod(F.xxhash64("user_id"), F.lit(BUCKETS)).alias("bucket"), F.isnull("user_id").alias("no_user"), F.coalesce("user_id", F.lit(0)).cast("long").alias("user_id"), "ts", F.unix_micros("ts").alias("at"), "event_id", F.expr(state_sql).alias("state"))
    told = rows.groupBy("bucket").transformWithStateInPandas(Steps(idle), STEP, "Append", "EventTime")
    # A task opens a store and a Python worker in each batch, so there are but two a core.
    parts = min(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    wanted = {"spark.sql.streaming.stateStore.providerClass": ROCKS, "spark.sql.shuffle.partitions": str(parts)}
    held = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        run_once(told, "append", folder)
        last = spark.range(1).select(F.lit(CLOSING).cast("timestamp_ntz").cast(schema["ts"].dataType).alias("ts"))
        last.select(*[F.col("ts") if f.name == "ts" else F.lit(None).cast(f.dataType).alias(f.name) for f in schema]).write.mode("append").parquet(closing)
        return run_once(told, "append", folder)
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)


def audited(spark: SparkSession, path: str, state_sql: str) -> DataFrame:
    """Steps of each user, how many are illegal, and the last state."""
    told = steps(spark, path, state_sql).groupBy("user_id")
    return told.agg(F.max_by("state", "step").alias("state"), F.count("*").alias("steps"), F.count_if(~F.col("legal")).alias("illegal"))
