"""Every query with SQL gives the rows that DuckDB gives."""

import pytest

from wordloom.plans import catalogue


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_same_rows(name, same_rows):
    same_rows(catalogue.queries()[name], catalogue.oracle_sql()[name])


def test_every_sql_has_a_query():
    assert set(catalogue.oracle_sql()) <= set(catalogue.queries())


def test_balanced_positions_use_several_tasks(spark, data):
    from pyspark.sql import functions as F

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = catalogue.queries()["balanced_positions"](spark, data).select("position", F.spark_partition_id().alias("task")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    shares = [sum(r["position"] == p for r in rows) for p in range(4)]
    assert len({r["task"] for r in rows}) > 1 and max(shares) - min(shares) <= 1


@pytest.mark.parametrize(
    ("name", "column", "rules"),
    [
        ("identity_errors", "errors", ("item_missing", "stage_item_mismatch", "section_mismatch")),
        ("verified_selections", "errors", ("not_a_partition", "order_changed", "wrong_number")),
        ("file_drift", "drift", ("changed", "missing", "added")),
    ],
)
def test_every_rule_is_met(name, column, rules, spark, data):
    met = {x for r in catalogue.queries()[name](spark, data).collect() for x in r[column].split(",")}
    assert met >= set(rules)


def test_both_sides_of_id_sets(spark):
    from wordloom.operators import raters

    a, b = (spark.createDataFrame([(x,) for x in ids], "k long") for ids in ((1, 2, 2, 3), (3, 4, 4)))
    assert {(r.k, r.side) for r in raters.id_sets(a, b, "k").collect()} == {(1, "missing"), (2, "missing"), (4, "unexpected")}


def test_phrases_that_are_too_many_to_broadcast(same_rows, monkeypatch):
    from wordloom.plans import text_queries

    monkeypatch.setattr(text_queries, "MOST_PHRASES", 0)
    same_rows(catalogue.queries()["phrase_occurrences"], catalogue.oracle_sql()["phrase_occurrences"])
