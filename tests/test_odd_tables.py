"""Queries against their SQL on tables with what the small test data lacks: repeated ids, keys of large tables."""

import pytest

from conftest import plain
from wordloom.plans import catalogue


@pytest.fixture
def same_on(spark, data, tmp_path):
    """Write tables by DuckDB, run a query and its SQL over them and compare rows."""
    import duckdb

    def check(name, **tables):
        con = duckdb.connect()
        for table, sql in tables.items():
            con.execute(f"COPY ({sql.replace('{data}', data)}) TO '{tmp_path}/{table}.parquet' (FORMAT parquet)")
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet'")
        df = catalogue.queries()[name](spark, str(tmp_path))
        relation = con.sql(catalogue.oracle_sql()[name])
        order = [relation.columns.index(c) for c in df.columns]
        got, want = [tuple(map(plain, r)) for r in df.collect()], [tuple(plain(r[i]) for i in order) for r in relation.fetchall()]
        assert len(got) > 1 and sorted(got, key=str) == sorted(want, key=str)
        return got

    return check


def test_rows_of_one_doc_id_are_one_document(same_on):
    same_on("paragraph_bands", documents="SELECT doc_id // 3 AS doc_id, text FROM '{data}/documents.parquet'")


LINES = "SELECT * REPLACE (l_partkey * 49999 AS l_partkey, l_suppkey * 4999 AS l_suppkey) FROM '{data}/lineitem.parquet'"


@pytest.mark.parametrize("name", ["run_reconciliation", "signature_variants"])
def test_last_log_with_keys_of_large_tables(name, same_on):
    same_on(name, lineitem=LINES, orders="SELECT * FROM '{data}/orders.parquet'")


def test_span_quality_tells_the_class(same_on):
    got = same_on("span_quality", benchmark="SELECT * FROM '{data}/benchmark.parquet'")
    assert {x for r in got for x in r} >= {"CLEARLY_INCOHERENT", "BORDERLINE", "COHERENT"}


def test_children_are_spread_in_one_aggregation(spark):
    from wordloom.sources import records

    rows = spark.createDataFrame([(1, 1, 5.0), (1, 2, 6.0), (1, 2, 7.0), (2, 9, 1.0), (3, None, 2.0)], "k int, n int, v double")
    wide = records.spread(rows, "k", "n", [1, 2], "v")
    assert {tuple(r) for r in wide.select("k", "1_v", "2_v").collect()} == {(1, 5.0, 7.0), (2, None, None), (3, None, None)}
    assert wide._jdf.queryExecution().sparkPlan().toString().count("Aggregate") == 2  # partial and final; a pivot has four


def test_lines_are_dealt_by_their_number(spark, same_on, data, monkeypatch):
    from pyspark.sql import functions as F

    from wordloom.plans import record_queries

    monkeypatch.setattr(record_queries, "TASK_LINES", 100)
    told = catalogue.queries()["consensus_outcomes"](spark, data)
    assert told.select(F.spark_partition_id().alias("task")).distinct().count() > 30
    lines = "SELECT * REPLACE (CASE WHEN l_linenumber <> 2 THEN l_partkey % 9 END AS l_partkey, CASE WHEN l_linenumber <> 3 THEN l_returnflag END AS l_returnflag) FROM '{data}/lineitem.parquet'"
    same_on("consensus_outcomes", lineitem=lines, orders="SELECT * FROM '{data}/orders.parquet' UNION ALL SELECT * FROM '{data}/orders.parquet' WHERE o_orderkey % 7 = 0")
