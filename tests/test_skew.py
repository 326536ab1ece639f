"""Hot keys: one user leaves a third of all edges and asks a third of the requests, another
is the friend in a third and asked about in a third. The joins must split these keys."""

import re

import pytest
from pyspark.sql import functions as F

from kinweave.operators import changes, idmap, neighbourhood, roster, stored_graph
from kinweave.plans import jobs
from kinweave.sources.tables import write_table

ROWS = 60000
FORCE_SMALL_SCALE = {
    "spark.sql.shuffle.partitions": "32",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("hot"))
    session = spark.newSession()
    for key, value in FORCE_SMALL_SCALE.items():
        session.conf.set(key, value)

    def stored(name, df):
        return write_table(df.repartition(8), f"{folder}/{name}")

    def pairs(first, second, names):
        """A third of the rows has user 0 first, a third user 1 second."""
        number = F.col("id")
        return session.range(ROWS).select(
            number,
            F.when(number % 3 == 0, 0).otherwise(number * first % 59999).cast("string").alias(names[0]),
            F.when(number % 3 == 1, 1).otherwise(number * second % 59999).cast("string").alias(names[1]),
        )

    edges = stored("edges", pairs(7, 13, ("user_id", "friend_user_id")).drop("id").distinct())
    users = edges.select(F.explode(F.array("user_id", "friend_user_id")).alias("user_id")).distinct()
    id_map = stored("id_map", idmap.with_vertex_ids(users))
    people = stored("people", neighbourhood.people(edges, id_map))
    requests = stored("requests", pairs(11, 17, ("user_id", "candidate_id")).drop("id"))
    relation = stored("relation", pairs(7, 13, ("username", "loginAccount")).select(
        F.col("id").alias("rosterId"), "username", "loginAccount", F.col("loginAccount").alias("userId")
    ))
    vid_edges = stored("vid_edges", stored_graph.vid_edges(edges, id_map))
    return {name: value for name, value in locals().items() if name in (
        "session", "edges", "id_map", "people", "requests", "relation", "vid_edges")}


def joins(df):
    """The equi-join keys of the plan as run, with whether AQE split a hot key there."""
    execution = df._jdf.queryExecution()
    execution.executedPlan().execute().count()
    final = re.sub(r"#\d+L?", "", execution.executedPlan().toString().split("Initial Plan")[0])
    found = re.findall(r"SortMergeJoin(\(skew=true\))? \[([\w, ]+)\]", final)
    return {keys: bool(split) for split, keys in found}


def test_friendships_split_a_hot_owner(hot):
    assert joins(roster.friendships(hot["relation"]))["username"]


@pytest.mark.parametrize("question", [
    neighbourhood.friend_levels, neighbourhood.common_friend_count, neighbourhood.common_friends,
    neighbourhood.common_friends_pair, lambda *tables: neighbourhood.common_friends_set(*tables, chunks=4),
])
def test_questions_split_hot_users_and_hot_candidates(hot, question):
    found = joins(question(hot["requests"], hot["edges"], hot["people"]))
    assert found["user_id"] and found["candidate_id"] and found["via, anchor"]


def test_translations_split_hot_ends(hot):
    found = joins(stored_graph.vid_edges(hot["edges"], hot["id_map"]))
    assert found["user_id"] and found["friend_user_id"]
    found = joins(stored_graph.graph_friendships(hot["vid_edges"], hot["id_map"]))
    assert found["src_vid"] and found["dst_vid"]


def test_look_ups_split_hot_keys(hot):
    assert joins(stored_graph.registered_edges(hot["vid_edges"], hot["id_map"]))["src_vid"]
    seeds = hot["id_map"].select("user_id")
    assert joins(stored_graph.neighbours(seeds, hot["vid_edges"], hot["id_map"]))["src_vid"]
    found = joins(jobs.named_edges(hot["vid_edges"], hot["id_map"]))
    assert found["src_vid"] and found["dst_vid"]


def hot_log(hot):
    """Every second edge of user 0 is deleted, and user 2 adds everybody user 0 knows."""
    number = F.crc32("friend_user_id")
    of_hub = hot["edges"].where("user_id = '0'")
    drops = of_hub.where(number % 2 == 0).select("user_id", "friend_user_id", F.lit("delete").alias("op"), F.lit(1).cast("long").alias("seq"))
    adds = of_hub.select(F.lit("2").alias("user_id"), "friend_user_id", F.lit("add").alias("op"), F.lit(2).cast("long").alias("seq"))
    return drops.unionByName(adds)


def test_a_hot_id_is_resolved_in_every_row(hot):
    asked = hot["relation"].select(F.col("username").alias("user_id"))
    found = idmap.resolve_left(asked, hot["id_map"].where("user_id <> '7'"))
    assert found.count() == ROWS and found.where("user_id = '0' AND vertex_id IS NULL").isEmpty()
    assert found.where("vertex_id IS NULL").count() == asked.where("user_id = '7'").count()


def test_changes_of_a_hub_are_grouped_by_pair(hot):
    after = changes.apply_changes(hot["edges"], hot_log(hot))
    plan = after._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(user_id") == 1 and "Join" not in plan and "SortAggregate" not in plan
    edges, log = set(map(tuple, hot["edges"].collect())), [tuple(row) for row in hot_log(hot).collect()]
    expected = edges - {row[:2] for row in log if row[2] == "delete"} | {row[:2] for row in log if row[2] == "add"}
    assert set(map(tuple, after.collect())) == expected


def test_jobs_on_hot_keys_are_whole(hot, tmp_path):
    spark, root = hot["session"], str(tmp_path / "graph")
    expected = set(map(tuple, roster.friendships(hot["relation"]).collect()))
    graph = jobs.reset_then_load(spark, hot["relation"], root)
    assert graph.by_user.count() == len(expected) and set(map(tuple, graph.by_friend.collect())) == expected
    log = hot_log(hot)
    changed = jobs.apply_changes(spark, log, root)
    assert set(map(tuple, changed.by_user.collect())) == set(map(tuple, changes.apply_changes(graph.by_user, log).collect()))
    synced = jobs.sync(spark, hot["relation"], root)
    assert set(map(tuple, synced.by_user.collect())) == expected and synced.by_user.count() == len(expected)


def test_a_hub_costs_no_more_than_the_shorter_list(hot):
    """User 0 knows a third of all edges' ends; its requests list those who know the candidate instead."""
    asks = neighbourhood._sized(neighbourhood._asks(hot["requests"]), hot["people"])
    listed = asks.agg(F.sum(F.least("out_degree", "in_degree"))).first()[0]
    one_sided = asks.agg(F.sum("out_degree")).first()[0]
    assert listed < 20 * ROWS < one_sided


def test_answers_on_hot_keys_are_whole(hot):
    knows, known_by = {}, {}
    for user, friend in hot["edges"].collect():
        knows.setdefault(user, set()).add(friend)
        known_by.setdefault(friend, set()).add(user)
    asks = set(map(tuple, hot["requests"].collect()))
    common = {(u, c): knows.get(u, set()) & known_by.get(c, set()) for u, c in asks if u != c}
    common = {ask: middles for ask, middles in common.items() if middles}
    direct = {(u, c) for u, c in asks if c in knows.get(u, ())}
    ask = (hot["requests"], hot["edges"], hot["people"])
    counts = {(r.user_id, r.candidate_id): r.n_common for r in neighbourhood.common_friend_count(*ask).collect()}
    assert counts == {pair: len(middles) for pair, middles in common.items()}
    levels = {(r.user_id, r.candidate_id): r.level for r in neighbourhood.friend_levels(*ask).collect()}
    assert levels == {**{pair: 2 for pair in common}, **{pair: 1 for pair in direct}}
    chunks = {}
    for row in neighbourhood.common_friends_set(*ask, chunks=3).collect():
        chunks.setdefault((row.user_id, row.candidate_id), []).extend(row.common_ids.split(","))
    assert {pair: sorted(middles) for pair, middles in chunks.items()} == {
        pair: sorted(middles) for pair, middles in common.items()}
