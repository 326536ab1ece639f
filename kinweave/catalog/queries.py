"""One query per operator, each over whole tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from kinweave import schemas, session
from kinweave.catalog.inputs import HOT_THRESHOLD, Inputs, event_changes, inputs
from kinweave.functions import scalars
from kinweave.operators import changes, hot, idmap, neighbourhood, roster, stored_graph, versions
from kinweave.plans import jobs, store
from kinweave.sources import index, store_format, tables
from kinweave.streaming.changes import compact, current_edges, edges_behind, log_changes, read_log
from kinweave.streaming.live import accepted, log_judged

SET_CHUNKS = 4

_registered: dict[str, Callable[[Inputs], DataFrame]] = {}


def _query(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    _registered[build.__name__] = build
    return build


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def run(build):
        return lambda spark, sf_dir: build(inputs(spark, sf_dir))

    return {name: run(build) for name, build in _registered.items()}


# Roster

@_query
def max_roster_id(i):
    return roster.max_roster_id(i.roster)


@_query
def relation(i):
    return i.relation


@_query
def users(i):
    return roster.users(i.relation)


@_query
def friendships(i):
    return roster.friendships(i.relation)


# Id map

@_query
def id_map(i):
    return i.id_map_documents


@_query
def id_map_in_store(i):
    """The id map after a round trip through a document store, written in two jobs."""
    store_format.register(i.spark)
    path = session.new_folder(i.spark, "document-store")
    early = F.crc32("user_id") % 2 == 0
    for part in (i.id_map.where(early), i.id_map.where(~early)):
        index.write_id_map_documents(part, store_format.NAME, path)
    return index.read_id_map_documents(i.spark, store_format.NAME, path)


@_query
def missing_users(i):
    return idmap.missing_users(i.users, i.graph_id_map)


@_query
def id_map_upsert(i):
    return idmap.upsert(i.graph_id_map, i.id_map_updates)


@_query
def id_map_delete(i):
    return idmap.delete_documents(i.id_map, i.id_map_deletes)


@_query
def resolve_ids_left(i):
    return idmap.resolve_left(i.relation.select(F.col("userId").alias("user_id")), i.graph_id_map)


@_query
def resolve_ids_inner(i):
    return idmap.resolve_inner(i.relation.select(F.col("userId").alias("user_id")), i.graph_id_map)


@_query
def duplicate_user_ids(i):
    return idmap.duplicate_user_ids(i.relation.select(F.col("userId").alias("user_id")))


@_query
def duplicate_edges(i):
    return idmap.duplicate_edges(roster.owner_friend_pairs(i.relation))


# Stored graph, load and sync

@_query
def vid_edges(i):
    return stored_graph.vid_edges(i.friendships, i.id_map)


@_query
def graph_vid_edges(i):
    return stored_graph.registered_edges(i.graph_edges, i.graph_id_map)


@_query
def neighbours(i):
    return stored_graph.neighbours(i.users, i.graph_edges, i.graph_id_map)


@_query
def graph_friendships(i):
    return stored_graph.graph_friendships(i.graph_edges, i.graph_id_map)


@_query
def edge_diff(i):
    return stored_graph.edge_diff(graph_friendships(i), i.friendships)


@_query
def stale_edges(i):
    return stored_graph.stale_edges(edge_diff(i))


@_query
def missing_edges(i):
    return stored_graph.missing_edges(edge_diff(i))


@_query
def reset_then_load(i):
    return i.loaded.by_user


@_query
def synced_users(i):
    return i.synced.users


@_query
def synced_edges(i):
    return i.synced.by_friend


@_query
def synced_graph(i):
    return i.synced.vid_edges


@_query
def friendships_by_view(i):
    """The owner self-join as SQL over a cached view of the relation, which is dropped once the plan stands."""
    name = session.new_folder(i.spark, "relation").rsplit("-", 1)[1]
    view = f"relation_{name}"
    tables.register_views(**{view: i.relation})
    tables.cache_view(i.spark, view)
    found = i.spark.sql(f"""
        SELECT DISTINCT o.userId AS user_id, r.userId AS friend_user_id FROM {view} r
        JOIN (SELECT DISTINCT loginAccount, userId FROM {view}) o ON o.loginAccount = r.username""")
    found = tables.write_table(found, session.new_folder(i.spark, "friendships-by-view"))
    tables.drop_views(i.spark, view)
    return found


# Neighbourhood

@_query
def one_degree(i):
    return neighbourhood.one_degree(i.requests, i.friendships, i.people)


@_query
def two_degree(i):
    return neighbourhood.two_degree(i.requests, i.friendships, i.people)


@_query
def friend_levels(i):
    return neighbourhood.friend_levels(i.requests, i.friendships, i.people)


@_query
def common_friend_count(i):
    return neighbourhood.common_friend_count(i.requests, i.friendships, i.people)


@_query
def common_friends(i):
    return neighbourhood.common_friends(i.requests, i.friendships, i.people)


@_query
def common_friends_set(i):
    return neighbourhood.common_friends_set(i.requests, i.friendships, i.people, SET_CHUNKS)


@_query
def common_friends_pair(i):
    return neighbourhood.common_friends_pair(i.requests, i.friendships, i.people)


# Hot users

@_query
def hot_users(i):
    return hot.hot_users(i.friendships, HOT_THRESHOLD)


@_query
def hot_users_flagged(i):
    return hot.flagged_users(i.loaded.hot_flags)


# Changes

@_query
def edges_after_changes(i):
    return changes.apply_changes(i.friendships, i.changes)


@_query
def edges_after_delete(i):
    return changes.delete_edges(i.friendships, changes.valid(i.changes).where(F.col("op") == "delete"))


@_query
def users_after_changes(i):
    return changes.users_after_changes(i.users, i.changes)


@_query
def rejected_changes(i):
    return changes.rejected(i.changes)


@_query
def graph_after_changes(i):
    return i.changed.vid_edges


@_query
def people_after_changes(i):
    return i.changed.people


def _logged(i):
    """A log that a stream over the events has filled, and the folder it lies in."""
    # a stream reads no single file by its path, so the table's name is a pattern that only it matches
    events = i.spark.readStream.schema(i.table("events").schema).parquet(f"{i.sf_dir}/event[s].parquet")
    folder = session.new_folder(i.spark, "change-log")
    log_changes(event_changes(events), f"{folder}/log", f"{folder}/checkpoint").awaitTermination()
    return f"{folder}/log"


@_query
def edges_after_change_stream(i):
    return current_edges(i.friendships, read_log(i.spark, _logged(i)))


@_query
def edges_after_compaction(i):
    """The log folded into a snapshot, and what the log holds behind it applied: the same edges."""
    log, root = _logged(i), session.new_folder(i.spark, "compacted-graph")
    store.fork(i.spark, i.loaded, root)
    graph = compact(i.spark, log, root)
    return edges_behind(graph, read_log(i.spark, log, graph.applied_batch))


@_query
def edges_after_two_compactions(i):
    """The log in three parts, each with calls older than those before it: two folded into snapshots, one on top."""
    log = i.written_event_changes
    third = F.crc32(F.col("seq").cast("string")) % 3
    root = session.new_folder(i.spark, "twice-compacted-graph")
    store.fork(i.spark, i.loaded, root)
    jobs.apply_changes(i.spark, log.where(third == 2), root)
    graph = jobs.apply_changes(i.spark, log.where(third == 0), root)
    return edges_behind(graph, log.where(third == 1))


@_query
def edges_after_live_calls(i):
    """The events in four micro-batches, each with calls older than those before it, judged as they arrive."""
    folder = session.new_folder(i.spark, "live-calls")
    i.written_event_changes.repartition(4, F.crc32(F.col("seq").cast("string"))).write.parquet(f"{folder}/calls")
    calls = i.spark.readStream.schema(schemas.CHANGES).option("maxFilesPerTrigger", 1).parquet(f"{folder}/calls")
    log_judged(calls, f"{folder}/log", f"{folder}/checkpoint").awaitTermination()
    return versions.apply_changes(versions.of_edges(i.friendships), accepted(i.spark, f"{folder}/log"))


@_query
def degrees_after_two_logs(i):
    """Degrees kept up to date by the steps of two logs; ``people_after_changes`` and its kin count them anew."""
    root = session.new_folder(i.spark, "stepped-graph")
    store.fork(i.spark, i.loaded, root)
    late = F.crc32(F.col("seq").cast("string")) % 2 == 0
    jobs.apply_changes(i.spark, i.changes.where(late), root)
    return jobs.apply_changes(i.spark, i.changes.where(~late), root).people.where("registered").select("user_id", "out_degree", "in_degree")


@_query
def hot_users_after_changes(i):
    """Flags kept up to date by the steps of the degrees."""
    return hot.flagged_users(i.changed.hot_flags)


# Column helpers

@_query
def price_rounded(i):
    price = scalars.round_half_up(F.col("l_extendedprice"), 1)
    return i.table("lineitem").select("l_orderkey", "l_linenumber", price.alias("price"))


@_query
def price_truncated(i):
    price = scalars.truncate(F.col("l_extendedprice"), 1)
    return i.table("lineitem").select("l_orderkey", "l_linenumber", price.alias("price"))


@_query
def trimmed_array(i):
    texts = scalars.trim_array(F.array("s1", "s2"))
    return i.messy.select("c_custkey", F.explode(texts).alias("text"))


@_query
def trimmed_row(i):
    return scalars.trim_row(i.messy)


@_query
def first_or_default(i):
    return i.maybe_prices.select(
        "o_orderkey",
        scalars.first_or_default(F.col("prices"), -1.0).alias("price"),
        scalars.first_or_default(F.transform("prices", lambda p: p.cast("int")), -1).alias("whole_price"),
        scalars.first_rounded_or_default(F.col("prices"), -1.0).alias("rounded_price"),
    )
