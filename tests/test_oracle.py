"""Every query of the catalog against its SQL, over whole tables."""

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_point
from kinweave.catalog import oracle, queries as catalog

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def test_every_query_has_sql_and_is_registered():
    assert catalog.queries().keys() == oracle.oracle_sql().keys()
    assert catalog.queries().keys() <= entry_point.queries().keys()
    assert oracle.oracle_sql().items() <= entry_point.oracle_sql().items()


@pytest.mark.parametrize("name", list(catalog.queries()))
def test_query_equals_sql(spark, duck, name):
    result = catalog.queries()[name](spark, SF_DIR)
    expected = duck.execute(oracle.oracle_sql()[name])
    columns = [d[0] for d in expected.description]
    assert sorted(result.columns) == sorted(columns)
    rows = Counter(tuple(row) for row in result.select(*columns).collect())
    assert sum(rows.values()) > 0
    assert rows == Counter(expected.fetchall())


def test_entry(spark):
    result = entry_point.entry(spark)
    assert result.columns == ["user_id", "candidate_id", "level"]
    assert {row.level for row in result.collect()} == {1, 2}
