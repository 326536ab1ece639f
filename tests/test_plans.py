"""What the plans of the registered queries must and must not contain."""

import pytest

from kinweave.catalog import queries as catalog
from kinweave.catalog.inputs import inputs
from kinweave.operators import neighbourhood, roster

SF_DIR = "/root/testdata/sf0.001"
NEVER = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow", "MapPartitions", "Window", "Limit", "TakeOrdered")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(catalog.queries()))
def test_no_pairing_no_python_no_window_no_limit(spark, name):
    plan = plan_of(catalog.queries()[name](spark, SF_DIR))
    assert not [operator for operator in NEVER if operator in plan]


def test_relation_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(roster.users(inputs(spark, SF_DIR).relation))
    assert "EqualTo(sub,3)" in plan and "IsNotNull(userID)" in plan
    assert "rosterID" not in plan.split("ReadSchema")[1]


def test_two_sessions_keep_their_own_tables_and_settings(spark):
    other = spark.newSession()
    other.conf.set("spark.sql.shuffle.partitions", "3")
    before = dict(spark.conf.getAll)
    first, second = inputs(spark, SF_DIR), inputs(other, SF_DIR)
    assert first is inputs(spark, SF_DIR) and first is not second
    assert second.spark.conf.get("spark.sql.shuffle.partitions") == "3" != first.spark.conf.get("spark.sql.shuffle.partitions")
    assert dict(spark.conf.getAll) == before
    assert first.users.count() == second.users.count()


@pytest.mark.parametrize("name, scanned", [("id_map", "documents-"), ("hot_users_flagged", "/hot_flags")])
def test_stored_tables_are_read(spark, name, scanned):
    files = catalog.queries()[name](spark, SF_DIR).inputFiles()
    assert files and all(scanned in file for file in files)


def test_one_shuffle_of_the_edges_serves_all_look_ups(spark):
    session = spark.newSession()
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    given = inputs(spark, SF_DIR)
    requests, friendships, people = (
        session.read.schema(df.schema).parquet(*df.inputFiles())
        for df in (given.requests, given.friendships, given.people)
    )
    for question in (neighbourhood.friend_levels, neighbourhood.two_degree):
        df = question(requests, friendships, people)
        df.collect()
        final = plan_of(df).split("Initial Plan")[0]
        assert final.count("ReusedExchange") == 1
