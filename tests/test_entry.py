"""Every query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as contract
from tools.check_queries import sorted_rows

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for file in sorted(os.listdir(SF_DIR)):
        connection.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{SF_DIR}/{file}'")
    return connection


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["c_mktsegment", "avg_balance", "customers", "overdrawn"]
    assert df.count() > 0


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_sql(spark, db, name):
    df = contract.queries()[name](spark, SF_DIR)
    cursor = db.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    got = [tuple(r) for r in df.collect()]
    assert sorted_rows(df.columns, got) == sorted_rows(columns, cursor.fetchall())


@pytest.mark.parametrize("name", ["h7_vector_element", "i7_logistic_regression"])
def test_query_without_sql_gives_rows(spark, name):
    assert contract.queries()[name](spark, SF_DIR).count() > 0
