"""Every registered query against its SQL twin on the smallest tables."""

import decimal
import glob
import math
import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tidegate.workload import QUERIES, SQL

TABLES = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(TABLES), reason="driver tables are absent")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in glob.glob(f"{TABLES}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    yield connection
    connection.close()


def comparable(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    if isinstance(value, decimal.Decimal):
        return f"{value.normalize():f}"
    return repr(value)


def table(columns, data):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return [columns[i] for i in order], sorted([comparable(row[i]) for i in order] for row in data)


def test_names_match():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(queries()) and set(SQL) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, database, name):
    df = QUERIES[name](spark, TABLES)
    result = database.execute(SQL[name])
    expected = table([column[0] for column in result.description], result.fetchall())
    assert expected[1], "the comparison should have rows"
    assert table(df.columns, df.collect()) == expected


def test_entry(spark):
    assert entry(spark).count() > 0
