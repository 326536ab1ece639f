"""Calls in any order and any number of logs give what the whole log gives."""

import random

import pytest

from kinweave import schemas
from kinweave.operators import changes, idmap, versions
from kinweave.plans import jobs, store
from kinweave.streaming.changes import compact, edges_behind, log_changes, read_log


def rows(df):
    return sorted(map(tuple, df.collect()))


def random_log(rng, pairs, n):
    return [(*rng.choice(pairs), rng.choice(["add", "add", "delete"]), rng.randint(1, n // 3)) for _ in range(n)]


def whole_log(edges, log):
    """The plain rule: the last call of a pair by seq decides, at equal seq a delete."""
    last = {}
    for user, friend, op, seq in log:
        last[user, friend] = max(last.get((user, friend), (0, False)), (seq, op == "delete"))
    kept = {pair for pair in edges if pair not in last}
    return sorted(kept | {pair for pair, (_, deleted) in last.items() if not deleted})


@pytest.fixture(scope="module")
def users():
    return [f"u{n}" for n in range(30)]


@pytest.mark.parametrize("seed", range(3))
def test_logs_merge_in_any_order_split_and_repeated(make, users, seed):
    rng = random.Random(seed)
    pairs = [(a, b) for a in users for b in users if a != b]
    edges, log = rng.sample(pairs, 200), random_log(rng, pairs, 900)
    parts = [[] for _ in range(5)]
    for call in log:
        for part in rng.sample(parts, rng.choice([1, 1, 2])):
            part.append(call)
    tables = [versions.of_edges(make(schemas.FRIENDSHIPS, *edges))] + [versions.of_calls(make(schemas.CHANGES, *part)) for part in parts]
    rng.shuffle(tables)
    left = versions.merge(versions.merge(*tables[:3]), versions.merge(*tables[2:]))
    assert rows(versions.current(left)) == whole_log(edges, log)
    whole = changes.apply_changes(make(schemas.FRIENDSHIPS, *edges), make(schemas.CHANGES, *log))
    assert rows(whole) == whole_log(edges, log)


def test_a_sync_decides_until_a_later_call(make):
    def state(*row):
        return versions.current(make(schemas.VERSIONS, ("a", "b", *row))).count()

    assert state(3, 10, None, 10) == 1      # synced in after the delete with seq 10
    assert state(3, 10, None, 12) == 0      # deleted again
    assert state(2, 10, 12, None) == 1 and state(2, 10, 10, None) == 0
    assert state(3, None, 5, 5) == 0 and state(None, None, 6, 5) == 1
    assert state(None, None, None, 5) == 0 and state(None, None, None, None) == 0


@pytest.fixture
def graph_of(spark, make, tmp_path):
    def build(users, edges, **options):
        id_map = idmap.with_vertex_ids(make(schemas.USERS, *[(user,) for user in users]))
        vid = dict(rows(id_map))
        root = str(tmp_path / "graph")
        jobs.import_edges(spark, make(schemas.VID_EDGES, *[(vid[a], vid[b]) for a, b in edges]), id_map, root, **options)
        return root
    return build


def test_a_late_call_behind_a_compaction_counts_by_its_seq(spark, tmp_path, graph_of):
    root = graph_of(["a", "b"], [])
    source, log, checkpoint = (str(tmp_path / name) for name in ("source", "log", "checkpoint"))

    def arrive(*calls):
        spark.createDataFrame(list(calls), schemas.CHANGES).write.mode("append").parquet(source)
        log_changes(spark.readStream.schema(schemas.CHANGES).parquet(source), log, checkpoint).awaitTermination()

    arrive(("a", "b", "add", 10), ("b", "a", "delete", 20))
    graph = compact(spark, log, root)
    arrive(("a", "b", "delete", 5), ("b", "a", "add", 15))
    assert rows(edges_behind(graph, read_log(spark, log, graph.applied_batch))) == [("a", "b")]
    assert rows(compact(spark, log, root).by_user) == [("a", "b")]
    arrive(("a", "b", "delete", 11), ("b", "a", "add", 21))
    assert rows(compact(spark, log, root).by_friend) == [("b", "a")]


def test_logs_one_by_one_with_a_sync_between(spark, make, users, graph_of):
    rng = random.Random(7)
    pairs = [(a, b) for a in users[:12] for b in users[:12] if a != b]
    edges = rng.sample(pairs, 40)
    root = graph_of(users, edges, hot_threshold=4)
    log = random_log(rng, pairs, 240)
    for part in (log[:120], log[60:180]):
        graph = jobs.apply_changes(spark, make(schemas.CHANGES, *part), root)
    assert rows(graph.by_user) == rows(graph.by_friend) == whole_log(edges, log[:180])
    # everybody is friends with u0 in the roster: account ai belongs to user ui
    listed = [(f"a{n}", "a0", "u0") for n in range(1, 12)] + [("a0", f"a{n}", f"u{n}") for n in range(1, 12)]
    relation = make(schemas.RELATION, *[(n, *row) for n, row in enumerate(listed)])
    synced = sorted([(f"u{n}", "u0") for n in range(1, 12)] + [("u0", f"u{n}") for n in range(1, 12)])
    assert rows(jobs.sync(spark, relation, root, hot_threshold=4).by_user) == synced
    # what the sync knew of is history, later calls are not
    assert rows(jobs.apply_changes(spark, make(schemas.CHANGES, *log[:180]), root).by_user) == synced
    after = jobs.apply_changes(spark, make(schemas.CHANGES, ("u1", "u0", "delete", 1000), ("u1", "u0", "add", 999)), root)
    assert rows(after.by_user) == [pair for pair in synced if pair != ("u1", "u0")]
