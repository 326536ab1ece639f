from kinweave import schemas
from kinweave.operators import idmap, roster
from kinweave.plans import jobs, store
from kinweave.streaming.changes import compact, current_edges, log_changes, read_log


def rows(df):
    return sorted(map(tuple, df.collect()))


def arriving(spark, tmp_path):
    """Changes arrive in files; each call lets the stream log what is new."""
    source, log, checkpoint = (str(tmp_path / name) for name in ("source", "log", "checkpoint"))

    def arrive(*changes):
        spark.createDataFrame(list(changes), schemas.CHANGES).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schemas.CHANGES).parquet(source)
        log_changes(stream, log, checkpoint).awaitTermination()
    return log, arrive


def test_change_log_survives_restarts_and_holds_every_change_once(spark, tmp_path):
    log, arrive = arriving(spark, tmp_path)
    snapshot = spark.createDataFrame([("a", "b"), ("b", "c")], schemas.FRIENDSHIPS)
    arrive(("a", "b", "delete", 1), ("x", "y", "add", 2))
    assert rows(current_edges(snapshot, read_log(spark, log))) == [("b", "c"), ("x", "y")]
    arrive(("a", "b", "add", 4), ("x", "y", "delete", 3), ("x", "y", "add", 1))
    assert rows(current_edges(snapshot, read_log(spark, log))) == [("a", "b"), ("b", "c")]
    assert read_log(spark, log).count() == 5


def test_a_compacted_log_is_empty_and_later_changes_begin_behind_it(spark, tmp_path):
    log, arrive = arriving(spark, tmp_path)
    root = str(tmp_path / "graph")
    users = idmap.with_vertex_ids(spark.createDataFrame([("a",), ("b",)], schemas.USERS))
    vid = dict(rows(users))
    jobs.import_edges(spark, spark.createDataFrame([(vid["a"], vid["b"])], schemas.VID_EDGES), users, root)
    arrive(("b", "c", "add", 1), ("a", "b", "delete", 2))
    graph = compact(spark, log, root)
    assert rows(graph.by_user) == [("b", "c")]
    assert read_log(spark, log, graph.applied_batch).isEmpty()
    assert compact(spark, log, root).number == graph.number
    arrive(("c", "a", "add", 3), ("b", "c", "delete", 4))
    new = read_log(spark, log, graph.applied_batch)
    assert new.count() == 2 and rows(current_edges(graph.by_user, new)) == [("c", "a")]
    after = compact(spark, log, root)
    assert rows(after.by_user) == [("c", "a")] and after.applied_batch > graph.applied_batch
    nobody = roster.relation(spark.createDataFrame([], schemas.ROSTER))
    assert jobs.sync(spark, nobody, root).applied_batch == after.applied_batch
    assert store.open_graph(spark, root).number == after.number + 1
