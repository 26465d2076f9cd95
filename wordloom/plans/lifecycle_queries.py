"""Lifecycles: a user's events stand in for an item's states."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import lifecycle as li
from ..sources.state_store import StaleState, StateStore, UnsoundState
from ..sources.storage import fresh_folder
from ..streaming import lifecycle as live
from .registry import load, query

_STATE = "CASE event_type WHEN 'signup' THEN 'GENERATED' WHEN 'view' THEN 'REVIEWING' WHEN 'click' THEN 'SOLVING' WHEN 'error' THEN 'VALIDATION_FAILED' ELSE 'ACCEPTED' END"
_LEGAL = " OR ".join(f"(before = '{s}' AND state IN ({', '.join(repr(x) for x in f)}))" for s, f in li.TRANSITIONS.items() if f)
_STEPS = f"""WITH s AS (SELECT user_id, event_id, ts, {_STATE} AS state FROM events),
l AS (SELECT user_id, event_id, state, lag(state) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS step FROM s)"""


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events").select("user_id", "event_id", "ts", F.expr(_STATE).alias("state"))


@query(f"{_STEPS} SELECT user_id, event_id, state, before, step::BIGINT AS step, coalesce(before IS NULL OR {_LEGAL}, FALSE) AS legal FROM l")
def transition_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every state change and whether the transition table allows it."""
    told = li.steps(states(spark, sf_dir), "user_id", ["ts", "event_id"], "state")
    return told.select("user_id", "event_id", "state", "before", F.col("step").cast("long").alias("step"), "legal")


@query("""
SELECT user_id, event_id, count(*) FILTER (value < 10) OVER w AS failures, count(*) FILTER (value < 10) OVER w > 3 AS exhausted FROM events
WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def retry_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failures so far of each user and kind, and whether they pass the limit."""
    events = load(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", "value")
    return li.retries(events, "user_id", ["ts", "event_id"], "event_type", F.col("value") < 10, 3).select("user_id", "event_id", "failures", "exhausted")


@query(f"{_STEPS}, f AS (SELECT user_id, max_by(state, step) AS state FROM l GROUP BY user_id) SELECT state, count(*)::BIGINT AS n FROM f GROUP BY state")
def state_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items by their last state."""
    last = states(spark, sf_dir).groupBy("user_id").agg(F.max_by("state", F.struct("ts", "event_id")).alias("state"))
    return last.groupBy("state").agg(F.count("*").alias("n"))


@query(f"{_STEPS}, f AS (SELECT user_id, max_by(state, step) AS state, max(step) AS steps FROM l GROUP BY user_id) SELECT user_id, CASE state WHEN 'GENERATED' THEN 'reviewer' WHEN 'REVIEWING' THEN 'reviewer' WHEN 'SOLVING' THEN 'solver' WHEN 'VALIDATION_FAILED' THEN 'generator' END AS stage, steps::BIGINT AS steps FROM f WHERE state <> 'ACCEPTED'")
def pending_by_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which stage each unfinished item waits for, failures that may be retried included."""
    last = states(spark, sf_dir).groupBy("user_id").agg(F.max_by("state", F.struct("ts", "event_id")).alias("state"), F.count("*").alias("steps"))
    stage = F.expr("CASE state WHEN 'GENERATED' THEN 'reviewer' WHEN 'REVIEWING' THEN 'reviewer' WHEN 'SOLVING' THEN 'solver' WHEN 'VALIDATION_FAILED' THEN 'generator' END")
    return last.where("state <> 'ACCEPTED'").select("user_id", stage.alias("stage"), "steps")


@query("""
SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*)::BIGINT AS n FROM events GROUP BY ALL""")
def daily_counts_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events a day and kind, counted by a stream with a watermark."""
    return live.daily_counts(spark, f"{sf_dir}/events.parquet")


@query(f"{_STEPS} SELECT user_id, event_id, state, before, step::BIGINT AS step, coalesce(before IS NULL OR {_LEGAL}, FALSE) AS legal FROM l")
def streamed_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transition audit by a stream: events wait until the watermark has passed them, so that their order is that of their times."""
    return live.steps(spark, f"{sf_dir}/events.parquet", _STATE)


@query(f"{_STEPS} SELECT user_id, max_by(state, step) AS state, count(*)::BIGINT AS steps, count(*) FILTER (NOT coalesce(before IS NULL OR {_LEGAL}, FALSE))::BIGINT AS illegal FROM l GROUP BY user_id")
def stateful_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's last state, steps and illegal steps, from the streamed audit."""
    return live.audited(spark, f"{sf_dir}/events.parquet", _STATE)


_WANTED = "CASE l_returnflag || l_linestatus WHEN 'AF' THEN 'REVIEWING' WHEN 'NF' THEN 'SOLVING' WHEN 'RF' THEN 'REVISE_REQUIRED' WHEN 'AO' THEN 'GENERATED' WHEN 'NO' THEN 'ACCEPTED' ELSE 'VALIDATION_FAILED' END"


@query(f"""
WITH RECURSIVE w AS (SELECT l_orderkey AS k, l_linenumber AS round, max_by({_WANTED}, lpad((l_partkey * 100000 + l_suppkey)::VARCHAR, 20, '0') || {_WANTED}) AS wanted FROM lineitem GROUP BY ALL),
r AS (SELECT o_orderkey AS k, 0 AS round, ['GENERATED'] AS history, 0 AS refused, 1 AS version FROM orders
  UNION ALL SELECT r.k, r.round + 1, CASE WHEN legal THEN list_append(history, wanted) ELSE history END, refused + CASE WHEN wanted IS NOT NULL AND NOT legal THEN 1 ELSE 0 END, CASE WHEN wanted IS NULL THEN version ELSE r.round + 2 END
  FROM (SELECT r.*, wanted, coalesce({_LEGAL.replace("before", "history[-1]").replace("state IN", "wanted IN")}, FALSE) AS legal FROM r LEFT JOIN w ON w.k = r.k AND w.round = r.round + 1) r WHERE r.round < 7)
SELECT k AS o_orderkey, history[-1] AS state, array_to_string(history, '>') AS history, refused::BIGINT AS refused, version::BIGINT AS version, TRUE AS stale_refused, TRUE AS unsound_refused FROM r WHERE round = 7""")
def versioned_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States of orders saved in eight versions: a round of lines asks for steps, illegal ones are counted and not taken.

    Before the last round is saved, a writer with the version before and one with a broken history
    are refused.
    """
    store = StateStore(spark, fresh_folder(spark, "states"), "o_orderkey long, state string, history array<string>, refused long, version long", "o_orderkey")
    first = load(spark, sf_dir, "orders").select("o_orderkey", F.lit("GENERATED").alias("state"), F.array(F.lit("GENERATED")).alias("history"), F.lit(0).alias("refused"), F.lit(1).alias("version"))
    at = store.save(first, 0)
    asked = fresh_folder(spark, "asked")
    lines = load(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max_by(F.expr(_WANTED), F.expr(f"lpad(cast(l_partkey * 100000L + l_suppkey AS string), 20, '0') || {_WANTED}")).alias("wanted"))
    lines.where("l_linenumber BETWEEN 1 AND 7").select(F.col("l_orderkey").alias("o_orderkey"), "wanted", F.col("l_linenumber").alias("round")).write.partitionBy("round").parquet(asked)
    refused = {}
    for round_ in range(1, 8):
        rows, seen = store.load()
        met = rows.join(spark.read.schema("o_orderkey long, wanted string, round int").parquet(asked).where(F.col("round") == round_).drop("round").hint("merge"), "o_orderkey")
        legal = F.coalesce(li.allowed(F.col("state"), F.col("wanted")), F.lit(False))
        state = F.when(legal, F.col("wanted")).otherwise(F.col("state")).alias("state")
        history = F.when(legal, F.array_append("history", F.col("wanted"))).otherwise(F.col("history")).alias("history")
        changes = met.select("o_orderkey", state, history, (F.col("refused") + F.when(legal, 0).otherwise(1)).alias("refused"), F.lit(seen + 1).alias("version"))
        if round_ == 7:
            for name, error, wrong, version in (("stale_refused", StaleState, changes, seen - 1), ("unsound_refused", UnsoundState, changes.withColumn("history", F.array("state")), seen)):
                try:
                    store.save(wrong, version)
                    refused[name] = False
                except error:
                    refused[name] = True
        at = store.save(changes, seen)
    told = [F.lit(x).alias(name) for name, x in refused.items()]
    return store.load(at)[0].select("o_orderkey", "state", F.array_join("history", ">").alias("history"), "refused", "version", *told)
