"""What jobs write follows the change: levels of deltas, buckets that stay, degrees and flags by steps."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from kinweave import schemas
from kinweave.operators import hot, idmap, neighbourhood
from kinweave.plans import jobs, store
from kinweave.plans.parts import BASE, FANOUT
from kinweave.plans.questions import FriendGraph

N = 3000


def rows(df):
    return sorted(map(tuple, df.collect()))


def bytes_below(folder):
    return sum(path.stat().st_size for path in Path(folder).rglob("*.parquet"))


@pytest.fixture(scope="module")
def relation(spark, tmp_path_factory):
    """N users, each listing five others."""
    path = str(tmp_path_factory.mktemp("relation") / "rows")
    number = F.col("id")
    spark.range(5 * N).select(
        number.alias("rosterId"), F.concat(F.lit("a"), number % N).alias("username"),
        F.concat(F.lit("a"), (number % N * 7 + number / N * 31 + 1).cast("long") % N).alias("loginAccount")).withColumn(
        "userId", F.regexp_replace("loginAccount", "a", "u")).where("username <> loginAccount").write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def loaded(spark, relation, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("levels") / "graph")
    return jobs.reset_then_load(spark, relation, root, hot_threshold=6, buckets=16)


@pytest.fixture
def graph(spark, loaded, tmp_path):
    root = str(tmp_path / "graph")
    store.fork(spark, loaded, root)
    return root


def small_log(rng, number, n=12):
    return [(f"u{rng.randrange(N)}", f"u{rng.randrange(N)}", rng.choice(["add", "delete"]), rng.randint(1, 10 ** 6)) for _ in range(n)] + [
        (f"new{number}", "u1", "add", 5)]


def check_whole(graph):
    """Degrees, flags and digests as if counted anew from the edges."""
    pairs = rows(graph.by_user)
    assert len(pairs) == len(set(pairs)) and pairs == rows(graph.by_friend)
    edges = graph.by_user
    assert rows(graph.people) == rows(neighbourhood.people(edges, graph.id_map).select(*schemas.PEOPLE.fieldNames()))
    assert rows(graph.hot_flags) == rows(hot.hot_flags(graph.people, graph.hot_threshold))
    assert store.unequal_buckets(graph, edges, graph.buckets) == []
    assert graph.users.count() == graph.users.distinct().count()
    return set(pairs)


def test_small_logs_write_little_and_all_tables_stay_whole(spark, make, graph):
    rng = random.Random(1)
    expected = check_whole(store.open_graph(spark, graph))
    base = {part.path for part in store.open_graph(spark, graph).parts}
    size = sum(bytes_below(path) for path in base)
    last, levels = {}, set()
    for number in range(FANOUT + 2):
        log = small_log(rng, number)
        changed = jobs.apply_changes(spark, make(schemas.CHANGES, *log), graph)
        levels |= {part.level for part in changed.parts if part.table == "by_user"}
        assert bytes_below(changed.folder) < size / 4
        assert base <= {part.path for part in changed.parts}
        for user, friend, op, seq in log:
            last[user, friend] = max(last.get((user, friend), (0, False)), (seq, op == "delete"))
    expected = (expected - last.keys()) | {pair for pair, (_, deleted) in last.items() if not deleted}
    assert check_whole(changed) == expected
    assert levels == {BASE, 0, 1}
    assert all(len([part for part in changed.parts if part.table == "by_user" and part.level == level]) < FANOUT for level in (0, 1))


def test_a_large_log_goes_into_the_buckets_it_touches(spark, make, graph, loaded):
    of_one = [row.user_id for row in loaded.stored("by_user", [3]).select("user_id").distinct().collect()]
    log = make(schemas.CHANGES, *[(user, f"u{n}", "add", 1) for user in of_one for n in range(30)])
    changed = jobs.apply_changes(spark, log, graph)
    base = [part for part in changed.parts if part.table == "by_user"]
    assert all(part.level == BASE for part in base) and len(base) == 2
    assert {part.buckets for part in base} == {(3,), tuple(b for b in range(16) if b != 3)}
    assert check_whole(changed) == set(rows(loaded.by_user)) | {(user, f"u{n}") for user in of_one for n in range(30)}


def test_a_sync_without_news_writes_no_part(spark, relation, graph, loaded):
    synced = jobs.sync(spark, relation, graph, hot_threshold=6)
    assert set(synced.parts) == set(loaded.parts)


def test_a_sync_reads_only_the_buckets_that_differ_and_keeps_all_files(spark, relation, graph, loaded):
    gone = F.col("username").isin([f"a{n}" for n in range(0, N, 1000)])
    other = relation.where(~gone).unionByName(relation.where(gone).limit(1).select(
        F.lit(10 ** 6).cast("long").alias("rosterId"), F.lit("a2").alias("username"), F.lit("a77").alias("loginAccount"), F.lit("u77").alias("userId")))
    wanted = {(f"u{row.username[1:]}", row.userId) for row in other.collect()}
    apart = store.unequal_buckets(loaded, spark.createDataFrame(sorted(wanted), schemas.FRIENDSHIPS), loaded.buckets)
    assert 0 < len(apart) <= 4
    plan = loaded.stored("by_user", apart)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    synced = jobs.sync(spark, other, graph, hot_threshold=6)
    assert {part.path for part in loaded.parts} <= {part.path for part in synced.parts}
    assert bytes_below(synced.folder + "/diff") < bytes_below(loaded.folder + "/wanted") / 20
    assert check_whole(synced) == wanted


def test_another_threshold_judges_everybody(spark, relation, graph):
    assert check_whole(jobs.sync(spark, relation, graph, hot_threshold=4))


def test_flags_follow_from_degrees_without_a_scan_of_edges(spark, make, graph, loaded):
    moved = make(schemas.FRIENDSHIPS, ("u1", "u2"), ("u3", "u4")).withColumn("step", F.lit(1).cast("long"))
    steps = store.degree_steps(moved, make(schemas.ID_MAP, ("x", "vx")))
    assert rows(steps.select("user_id", "registered", "out_degree", "in_degree")) == [
        ("u1", False, 1, 0), ("u2", False, 0, 1), ("u3", False, 1, 0), ("u4", False, 0, 1), ("x", True, 0, 0)]
    assert not [file for file in loaded.people.inputFiles() + loaded.hot_flags.inputFiles() if "by_user" in file or "by_friend" in file]


def test_lookups_read_their_buckets_and_push_the_ids_down(spark, loaded):
    known = dict(rows(loaded.id_map))
    asked = ["u5", "u17", "nobody", "u5"]
    found = loaded.vertices_of(asked)
    assert rows(found) == [(user, known[user]) for user in ("u17", "u5")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "In(user_id, [nobody,u17,u5])" in plan or "In(user_id" in plan
    buckets = {row[0] for row in loaded.stored("id_map").where(F.col("user_id").isin(asked)).select("bucket").collect()}
    assert len(buckets) <= 2 and "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert loaded.vertices_of([]).isEmpty()
    with pytest.raises(ValueError, match="join"):
        loaded.vertices_of(map(str, range(store.SHORT_LIST + 1)))


def test_one_users_question_reads_its_bucket(spark, make, graph):
    jobs.apply_changes(spark, make(schemas.CHANGES, ("u1", "u2", "add", 3), ("me", "u1", "add", 4)), graph)
    asked = FriendGraph.open(spark, graph)
    assert rows(asked.friend_levels("me", ["u1", "u2", "u9"])) == [("me", "u1", 1), ("me", "u2", 2)]


def test_new_users_must_be_new(spark, make, graph):
    opened = store.open_graph(spark, graph)
    nothing = make(schemas.VERSIONS)
    moved = nothing.select("user_id", "friend_user_id", F.lit(1).cast("long").alias("step"))
    for users in ([("u1", "other")], [("x", "1"), ("x", "2")]):
        with pytest.raises(store.NotUnique):
            store.publish_changes(opened, f"{graph}-broken", nothing, moved, make(schemas.ID_MAP, *users), make(schemas.EDGES), -1, 6, 16)
    assert store.open_graph(spark, graph).number == opened.number


def test_vacuum_keeps_what_the_last_snapshots_list(spark, make, relation, tmp_path):
    root = str(tmp_path / "own")
    first = jobs.reset_then_load(spark, relation.where("rosterId < 200"), root, buckets=2)
    for number in range(3):
        last = jobs.apply_changes(spark, make(schemas.CHANGES, *[(f"u{n}", f"v{number}", "add", 1) for n in range(150)]), root)
    before = rows(last.by_user)
    gone = store.vacuum(spark, root, keep=1)
    assert gone and not {part.path for part in last.parts} & set(gone) and all(not Path(path).exists() for path in gone)
    assert {part.path for part in first.parts} & set(gone)
    assert rows(store.open_graph(spark, root).by_user) == before and check_whole(store.open_graph(spark, root))
    assert store.vacuum(spark, root, keep=1) == []
    with pytest.raises(ValueError):
        store.vacuum(spark, root, keep=0)
