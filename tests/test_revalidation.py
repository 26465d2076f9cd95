"""Reconciliation of recorded runs: every class, null keys, empty sides."""

from pyspark.sql import functions as F

from wordloom.operators import revalidation as rv


def told(spark, logs, outcomes, formal):
    made = (spark.createDataFrame(logs, "k string, at int, bad int"), spark.createDataFrame(outcomes, "k string, decision string"), spark.createDataFrame([(x,) for x in formal], "k string"))
    rules = [(F.col("bad") > 0, F.concat(F.lit("[x 1] [y] value "), F.col("bad").cast("string"), F.lit(".5 is bad"))), (F.col("bad") > 5, F.lit("far too bad"))]
    return {r.k: r for r in rv.reconciled(*made, "k", ["at"], rules).collect()}


def test_every_class(spark):
    logs = [("a", 1, 9), ("a", 2, 0), ("b", 1, 0), ("b", 2, 3), ("c", 1, 7), ("d", 1, 0), ("f", 1, 1), (None, 1, 2), ("h", 1, None)]
    outcomes = [("a", "ACCEPTED"), ("b", "FAILED"), ("c", "ACCEPTED"), ("d", "FAILED"), ("e", "ACCEPTED"), (None, "FAILED"), ("h", "OTHER"), ("i", "FAILED"), ("i", "FAILED")]
    got = told(spark, logs, outcomes, ["a", "a", "c", "d", "g", None])
    assert {k: (r.n_logs, r.n_outcomes, r.n_formal, r.presence, r.publication, r.replay) for k, r in got.items()} == {
        "a": (2, 1, 2, "complete", "published_twice", "clean"),
        "b": (2, 1, 0, "complete", "consistent", "reproduced"),
        "c": (1, 1, 1, "complete", "consistent", "missed"),
        "d": (1, 1, 1, "complete", "published_without_acceptance", "not_reproduced"),
        "e": (0, 1, 0, "no_log", "accepted_not_published", "open"),
        "f": (1, 0, 0, "no_outcome", "consistent", "open"),
        "g": (0, 0, 1, "no_outcome", "published_without_acceptance", "open"),
        None: (1, 1, 1, "complete", "published_without_acceptance", "reproduced"),
        "h": (1, 1, 0, "complete", "consistent", "open"),
        "i": (0, 2, 0, "no_log", "consistent", "open"),
    }
    assert got["b"].signature == ["value # is bad"] and got["c"].signature == ["far too bad", "value # is bad"] and got["c"].errors[0] == "[x 1] [y] value 7.5 is bad"


def test_empty_sides(spark):
    assert told(spark, [], [], []) == {}
    assert told(spark, [("a", 1, 1)], [], [])["a"].presence == "no_outcome"
    assert told(spark, [], [], ["a", "a"])["a"].n_formal == 2
