"""The registered queries of the subpackage against their SQL, over whole tables."""

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_point
from kinweave.llm import queries, sql

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_every_operator_and_the_pipeline_are_registered():
    names = list(entry_point.queries())
    assert [name.split("_")[0] for name in queries.queries()] == [f"op{n}" for n in range(1, 14)]
    assert set(queries.queries()) | {"pipeline"} <= set(names)
    assert sql.oracle_sql().items() <= entry_point.oracle_sql().items()


@pytest.mark.parametrize("name", list(sql.oracle_sql()))
def test_query_equals_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "embeddings"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    expected = connection.execute(sql.oracle_sql()[name])
    columns = [d[0] for d in expected.description]
    found = queries.queries()[name](spark, SF_DIR)
    assert sorted(found.columns) == sorted(columns)
    rows = Counter(map(tuple, found.select(*columns).collect()))
    assert sum(rows.values()) > 0 and rows == Counter(expected.fetchall())
