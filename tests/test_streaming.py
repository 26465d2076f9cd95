"""Event-time state: the same steps however the events are cut into batches."""

import random

import pytest
from pyspark.sql import functions as F

from wordloom.operators import lifecycle
from wordloom.plans.lifecycle_queries import _STATE, states
from wordloom.streaming import lifecycle as live


def batch(spark, data):
    told = lifecycle.steps(states(spark, data), "user_id", ["ts", "event_id"], "state")
    return sorted((r.user_id, r.event_id, r.state, r.before, r.step, bool(r.legal)) for r in told.collect())


def streamed(rows):
    return sorted((r.user_id, r.event_id, r.state, r.before, r.step, r.legal) for r in rows.collect())


def in_files(spark, data, folder, parts, seed):
    """The events dealt over files at random, which are read in the order of their times of writing."""
    rows = spark.read.parquet(f"{data}/events.parquet").where("user_id < 40")
    ids = [r[0] for r in rows.select("event_id").collect()]
    random.Random(seed).shuffle(ids)
    for n in range(parts):
        rows.where(F.col("event_id").isin(ids[n::parts])).coalesce(1).write.mode("append").parquet(f"file://{folder}")
    return rows


@pytest.mark.parametrize("parts", [1, 4])
def test_any_cut_into_batches(spark, data, tmp_path, parts):
    in_files(spark, data, tmp_path / "in", parts, parts)
    got = streamed(live.steps(spark, f"file://{tmp_path}/in/", _STATE, delay="60 days", files_at_once=1))
    assert got == [r for r in batch(spark, data) if r[0] < 40] and len(got) > 100


def test_a_silent_key_begins_anew(spark, data, tmp_path):
    rows = in_files(spark, data, tmp_path / "in", 3, 9)
    idle = 3 * 24 * 3600 * 10**6
    got = streamed(live.steps(spark, f"file://{tmp_path}/in/", _STATE, delay="60 days", idle=idle, files_at_once=1))
    want, last = [], {}
    for r in sorted(rows.select("user_id", "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"), F.expr(_STATE).alias("s")).collect(), key=lambda r: (r.at, r.event_id)):
        at, before, step = last.get(r.user_id, (None, None, 0))
        if at is not None and r.at - at > idle:
            before, step = None, 0
        want.append((r.user_id, r.event_id, r.s, before, step + 1, before is None or r.s in lifecycle.TRANSITIONS.get(before, ())))
        last[r.user_id] = (r.at, r.s, step + 1)
    assert got == sorted(want, key=lambda r: r[:2]) and any(r[3] is None and r[4] == 1 for r in got)
    assert sum(r[4] == 1 for r in got) > len(last)


def test_rows_later_than_the_watermark_are_left_out(spark, tmp_path):
    base = spark.createDataFrame([(1, "2024-01-01 00:00:00", 1, "signup"), (2, "2024-01-05 00:00:00", 1, "view")], "event_id long, ts string, user_id long, event_type string")
    late = spark.createDataFrame([(3, "2024-01-02 00:00:00", 1, "error"), (4, "2024-01-04 18:00:00", 1, "click")], base.schema)
    other = spark.createDataFrame([(5, "2024-01-05 00:00:00", 2, "view")], base.schema)  # rows are held against the watermark of the batch before
    for rows in (base, other, late):
        rows.withColumn("ts", F.col("ts").cast("timestamp_ntz")).coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/in")
    got = streamed(live.steps(spark, f"file://{tmp_path}/in/", _STATE, delay="12 hours", files_at_once=1))
    assert [r[1] for r in sorted(got, key=lambda r: r[4]) if r[0] == 1] == [1, 4, 2]


def test_users_share_few_buckets(spark, data, tmp_path, monkeypatch):
    monkeypatch.setattr(live, "BUCKETS", 3)
    rows = spark.read.parquet(f"{data}/events.parquet").where("user_id < 40").withColumn("user_id", F.expr("nullif(user_id, 7)"))
    rows.coalesce(1).write.parquet(f"file://{tmp_path}/in")
    told = lifecycle.steps(rows.select("user_id", "event_id", "ts", F.expr(_STATE).alias("state")), "user_id", ["ts", "event_id"], "state")
    plain = lambda r: (r.event_id, r.user_id, r.state, r.before, r.step, bool(r.legal))
    held = spark.conf.get("spark.sql.shuffle.partitions")
    got = sorted(map(plain, live.steps(spark, f"file://{tmp_path}/in/", _STATE).collect()))
    assert got == sorted(map(plain, told.collect())) and any(r[1] is None and r[4] > 1 for r in got)
    assert spark.conf.get("spark.sql.shuffle.partitions") == held
