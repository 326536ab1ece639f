"""Jobs over the stored graph: load, sync with the roster, change calls. Each publishes the next snapshot.

A job finds the edges that come and go and publishes those as deltas; what it writes follows the change, not the graph.

* Load and sync compare digests of the edges of each bucket with those of the relation first. Equal buckets are neither
  read nor joined; in the others stored and wanted pairs meet in one grouping.
* Change calls only read the buckets of the pairs they name. Versions keep the last calls of a pair, so a late call of an
  older seq changes nothing, whichever log it comes in.

Edges with an end that nobody knows are kept as vertex pairs; when new users make both ends known they become edges of users.
"""

from functools import reduce
from operator import and_

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from kinweave import schemas, session
from kinweave.operators import changes as calls, idmap, roster, versions
from kinweave.plans import store
from kinweave.plans.parts import bucket_of
from kinweave.plans.store import PAIR, Graph, named_edges
from kinweave.sources.tables import write_table


def reset_then_load(spark: SparkSession, relation: DataFrame, root: str, **options) -> Graph:
    """Empty the stored graph and fill it from the relation."""
    store.create(spark, root)
    return load(spark, relation, root, **options)


def load(spark: SparkSession, relation: DataFrame, root: str, **options) -> Graph:
    """Insert the users and edges that are absent; running it again adds nothing. Nothing is deleted."""
    return _follow_roster(spark, relation, root, False, **options)


def sync(spark: SparkSession, relation: DataFrame, root: str, **options) -> Graph:
    """Bring the stored graph in line with the relation: add users, drop stale edges, add missing ones.

    No user is removed, and edges with an end that nobody knows stay.
    """
    return _follow_roster(spark, relation, root, True, **options)


def import_edges(spark: SparkSession, vid_edges: DataFrame, id_map: DataFrame, root: str,
                 hot_threshold: int = store.HOT_THRESHOLD, buckets: int | None = None) -> Graph:
    """Make a graph that is stored elsewhere, as vertex pairs and an id map, the current snapshot."""
    folder = session.new_folder(spark, "import")
    id_map = write_table(id_map.select("user_id", "vertex_id"), f"{folder}/given-id-map")
    edges = write_table(named_edges(vid_edges, id_map), f"{folder}/given-edges")
    return store.import_graph(spark, root, folder, id_map, edges, hot_threshold, buckets)


def _follow_roster(spark, relation, root, delete_stale, bytes_per_partition=session.BYTES_PER_PARTITION,
                   hot_threshold=store.HOT_THRESHOLD, buckets=None) -> Graph:
    folder = session.new_folder(spark, "sync" if delete_stale else "load")
    graph = store.collapsed(store.open_graph(spark, root, bytes_per_partition), folder)
    # the source is read once: users and edges come from one state of it
    path = f"{folder}/relation"
    own = session.tuned(spark, write_table(relation, path), *_sized(graph), bytes_per_partition=bytes_per_partition)
    relation = own.read.parquet(path)
    buckets = graph.buckets if graph.parts else buckets or store.buckets_for(relation)
    new_users = write_table(idmap.with_vertex_ids(idmap.missing_users(roster.users(relation), graph.id_map)), f"{folder}/new-users")
    opened = _opened(graph, new_users, folder)
    wanted = roster.friendships(relation)
    if not delete_stale:
        wanted = wanted.unionByName(opened.select(*PAIR)).distinct()
    wanted = write_table(wanted, f"{folder}/wanted")
    if graph.parts:
        apart = store.unequal_buckets(graph, wanted, buckets)
        diff = write_table(_difference(graph, wanted, apart, buckets, delete_stale), f"{folder}/diff")
    else:  # all that is wanted comes
        diff = wanted.select(*PAIR, F.lit(None).cast("long").alias("upto"), F.lit(1).cast("long").alias("step"))
    news = diff.select(*PAIR, (F.lit(2 * (graph.epoch + 1)).cast("long") + (F.col("step") > 0).cast("long")).alias("forced"),
                       "upto", *[F.lit(None).cast("long").alias(name) for name in ("added", "deleted")])
    return store.publish_changes(graph, folder, news, diff.select(*PAIR, "step"), new_users, opened, graph.applied_batch, hot_threshold, buckets)


def _difference(graph: Graph, wanted: DataFrame, apart: list[int], buckets: int, delete_stale: bool) -> DataFrame:
    """Pairs of the given buckets that come (step 1) or go (step -1), with the last call known of them.

    Stored versions and wanted pairs meet in one grouping of numbers: one shuffle, no sort, no hot key.
    """
    stored = graph.stored("by_user", apart).select(*PAIR, *versions.VALUES, F.lit(0).alias("wanted"))
    given = wanted if len(apart) == buckets else wanted.where(bucket_of(F.col("user_id"), buckets).isin(apart))
    both = stored.unionByName(given.select(*PAIR, F.lit(1).alias("wanted")), allowMissingColumns=True)
    pairs = both.groupBy(*PAIR).agg(*[F.max(name).alias(name) for name in (*versions.VALUES, "wanted")])
    there, asked = versions.is_present(), F.col("wanted") == 1
    step = F.when(asked & ~there, 1).when(F.lit(delete_stale) & there & ~asked, -1).cast("long")
    return pairs.select(*PAIR, versions.last_seq().alias("upto"), step.alias("step")).where(F.col("step").isNotNull())


def apply_changes(spark: SparkSession, changes: DataFrame, root: str, applied_batch: int | None = None,
                  bytes_per_partition: int = session.BYTES_PER_PARTITION,
                  hot_threshold: int | None = None) -> Graph:
    """Apply a log of add and delete calls: both users of an add, their ids and the edge; a delete drops the edge.

    Rows that are no call are written to ``rejects`` in the snapshot's folder and change nothing. Calls may come in any order
    and any number of logs, also repeated: the last call of a pair by seq counts, whichever log held it. A call older
    than the last one a sync knew of is history.
    """
    folder = session.new_folder(spark, "changes")
    graph = store.collapsed(store.open_graph(spark, root, bytes_per_partition), folder)
    write_table(calls.rejected(changes), f"{folder}/rejects")
    path = f"{folder}/calls"
    own = session.tuned(spark, write_table(calls.valid(changes), path), bytes_per_partition=bytes_per_partition)
    log = own.read.parquet(path)
    buckets = graph.buckets
    added = calls.added_users(log)
    named = _buckets_of(added, "user_id", buckets)
    # a short list meets the id map as the broadcast side, and what is left of the id map is short too
    known = graph.stored("id_map", named).join(added, "user_id", "left_semi")
    new_users = write_table(idmap.with_vertex_ids(idmap.missing_users(added, known)), f"{folder}/new-users")
    opened = _opened(graph, new_users, folder)
    called = versions.merge(versions.of_calls(log), versions.of_edges(opened, graph.epoch + 1))
    called = write_table(called, f"{folder}/called")
    diff = write_table(_moves(graph, called, _buckets_of(called, "user_id", buckets)), f"{folder}/diff")
    batch = graph.applied_batch if applied_batch is None else applied_batch
    threshold = graph.hot_threshold if hot_threshold is None else hot_threshold
    moved = diff.where("step <> 0").select(*PAIR, "step")
    return store.publish_changes(graph, folder, diff.select(*PAIR, *versions.VALUES), moved, new_users, opened, batch, threshold, buckets)


def _moves(graph: Graph, called: DataFrame, named: list[int]) -> DataFrame:
    """The merged versions of called pairs that tell something new, with the step their edge makes."""
    stored = graph.stored("by_user", named).join(called.select(*PAIR), list(PAIR), "left_semi").select(*PAIR, *versions.VALUES)
    before = stored.select("*", *[F.col(name).alias(f"old_{name}") for name in versions.VALUES])
    both = before.unionByName(called.select(*PAIR, *versions.VALUES), allowMissingColumns=True)
    after = both.groupBy(*PAIR).agg(*[F.max(name).alias(name) for name in before.columns if name not in PAIR])
    step = versions.is_present().cast("long") - versions.is_present("old_").cast("long")
    same = [F.col(name).eqNullSafe(F.col(f"old_{name}")) for name in versions.VALUES]
    return after.where(~reduce(and_, same)).select(*PAIR, *versions.VALUES, step.alias("step"))


def _opened(graph: Graph, new_users: DataFrame, folder: str) -> DataFrame:
    """Open edges both of whose ends are known now that the new users are, as EDGES."""
    if not graph.parts_of("open_edges"):
        return new_users.sparkSession.createDataFrame(pa.Table.from_pylist([], to_arrow_schema(schemas.EDGES)), schemas.EDGES)
    ends = new_users.select(F.col("vertex_id"))
    open_ = graph.open_edges
    candidates = open_.join(ends.withColumnRenamed("vertex_id", "src_vid"), "src_vid", "left_semi").unionByName(
        open_.join(ends.withColumnRenamed("vertex_id", "dst_vid"), "dst_vid", "left_semi")).distinct()
    known = graph.id_map.unionByName(new_users.select("user_id", "vertex_id"))
    both = F.col("user_id").isNotNull() & F.col("friend_user_id").isNotNull()
    return write_table(named_edges(candidates, known).where(both), f"{folder}/opened")


def _buckets_of(rows: DataFrame, column: str, buckets: int) -> list[int]:
    """The buckets that rows fall into: at most one number a bucket."""
    return sorted(row[0] for row in rows.select(bucket_of(F.col(column), buckets)).distinct().collect())


def _sized(graph: Graph) -> list[DataFrame]:
    return [graph.spark.read.schema(store.KINDS[part.table].stored).parquet(part.path)
            for part in graph.parts if part.table in ("by_user", "id_map")]
