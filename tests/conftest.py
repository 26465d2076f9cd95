import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"

DATA = os.environ.get("WORDLOOM_TEST_DATA", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    shared = tmp_path_factory.mktemp("shared")
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"file://{shared}")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    return DATA


@pytest.fixture(scope="session")
def duck(data):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{data}/{name}.parquet'")
    return con


def plain(value):
    """A value in one form, whichever engine it comes from."""
    if value is None or value != value:
        return None
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float) or type(value).__name__ in ("Decimal",):
        return f"{float(value):.9g}"
    return str(value)


@pytest.fixture(scope="session")
def same_rows(spark, duck, data):
    """Run a query and its SQL and compare columns, types of numbers aside, and rows."""

    def check(query, sql):
        df = query(spark, data)
        got = [tuple(plain(r[c]) for c in sorted(df.columns)) for r in df.collect()]
        relation = duck.sql(sql)
        order = sorted(range(len(relation.columns)), key=lambda i: relation.columns[i])
        want = [tuple(plain(r[i]) for i in order) for r in relation.fetchall()]
        assert sorted(df.columns) == sorted(relation.columns)
        assert sorted(got, key=str) == sorted(want, key=str)

    return check
