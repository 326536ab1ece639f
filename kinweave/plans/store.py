"""The stored graph: snapshots below a root folder, and a pointer to the current one.

A job only reads the current snapshot and publishes the next one: a list of parts, most of them those of
the snapshot before, and a row appended to the pointer last. A job that breaks off has changed
nothing, and readers of the old snapshot are not disturbed. One job at a time may write below a root.

Tables are stored in parts (see ``parts``), so a job writes what it changes:

| stored | row | combined by |
| --- | --- | --- |
| id_map | user_id, vertex_id | a user is added once |
| by_user, by_friend | the version of a pair (see ``versions``), clustered by either end | maximum |
| open_edges | src_vid, dst_vid of an edge with an end nobody knows; +1 when it came, -1 when it went | sum |
| people | user_id, registered, number of out- and in-edges, as steps | maximum, sum |
| hot_flags | user_id, whether it has friends and whether many, as steps | sum |
| digests | order-free digest of the edges of each bucket of by_user, as steps | sum |

``Graph`` shows them as the tables of ``TABLES``. Degrees, flags and digests follow from the steps of the
edges that a job moves: no job counts edges anew.
"""

from collections.abc import Iterable
from dataclasses import dataclass
from functools import cached_property, partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from kinweave import schemas, session
from kinweave.operators import idmap, neighbourhood, stored_graph, versions
from kinweave.plans import parts as stored_parts
from kinweave.plans.parts import BUCKET, Kind, Part, bucket_of

PAIR = ("user_id", "friend_user_id")
TABLES = {
    "users": schemas.USERS, "id_map": schemas.ID_MAP, "edges": schemas.EDGES, "by_user": schemas.FRIENDSHIPS,
    "by_friend": schemas.FRIENDSHIPS, "people": schemas.PEOPLE, "hot_flags": schemas.HOT_FLAGS,
}
NO_BATCH = -1
HOT_THRESHOLD = 1000
BYTES_PER_BUCKET = 256 << 20
FEWEST_BUCKETS = 8
SHORT_LIST = 1000

_VERSION = {name: "max" for name in versions.VALUES}
_SUMS = ("n", "low", "high", "low_back", "high_back")


KINDS = {
    "id_map": Kind(schemas.ID_MAP, ("user_id", "vertex_id"), {}, "user_id", lookups=True),
    "by_user": Kind(schemas.VERSIONS, PAIR, _VERSION, "user_id", versions.says_nothing),
    "by_friend": Kind(schemas.VERSIONS, PAIR, _VERSION, "friend_user_id", versions.says_nothing),
    "open_edges": Kind(schemas.OPEN_EDGES, ("src_vid", "dst_vid"), {"there": "sum"}, "src_vid", lambda: F.expr("there <= 0")),
    "people": Kind(schemas.PEOPLE, ("user_id",), {"registered": "max", "out_degree": "sum", "in_degree": "sum"}, "user_id",
                   lambda: F.expr("NOT registered AND out_degree = 0 AND in_degree = 0")),
    "hot_flags": Kind(schemas.FLAGS, ("user_id",), {"listed": "sum", "hot": "sum"}, "user_id", lambda: F.expr("listed <= 0")),
    "digests": Kind(schemas.DIGESTS, ("part",), {name: "sum" for name in _SUMS}, "part"),
}


class NotUnique(Exception):
    """A table holds a key twice that must be unique."""


@dataclass(frozen=True)
class Graph:
    """A snapshot. Its tables belong to a session of their own with the settings their joins need.

    ``collapsed`` is false for an imported graph, whose edges may repeat until the next job.
    """

    spark: SparkSession
    root: str
    folder: str
    number: int
    applied_batch: int
    epoch: int
    buckets: int
    collapsed: bool
    hot_threshold: int
    parts: tuple[Part, ...]

    def parts_of(self, table: str) -> list[Part]:
        return [part for part in self.parts if part.table == table]

    def stored(self, table: str, only: list[int] | None = None) -> DataFrame:
        """A table as stored, one row a key, with its bucket; of some buckets if they are given."""
        return stored_parts.read(self.spark, self.parts_of(table), KINDS[table], only)

    @cached_property
    def id_map(self) -> DataFrame:
        return self.stored("id_map").select("user_id", "vertex_id")

    @cached_property
    def users(self) -> DataFrame:
        return self.id_map.select("user_id")

    @cached_property
    def by_user(self) -> DataFrame:
        return versions.current(self.stored("by_user"))

    @cached_property
    def by_friend(self) -> DataFrame:
        return versions.current(self.stored("by_friend"))

    @cached_property
    def versions(self) -> DataFrame:
        """The version of every pair, with or without an edge."""
        return self.stored("by_user").select(*PAIR, *versions.VALUES)

    @cached_property
    def open_edges(self) -> DataFrame:
        """Edges with an end that the id map does not know."""
        return self.stored("open_edges").where("there > 0").select("src_vid", "dst_vid")

    @cached_property
    def edges(self) -> DataFrame:
        """All edges with vertices and users; a user id is NULL where the vertex is unknown."""
        source = self.id_map.select("user_id", F.col("vertex_id").alias("src_vid"))
        target = self.id_map.select(F.col("user_id").alias("friend_user_id"), F.col("vertex_id").alias("dst_vid"))
        known = self.by_user.join(source, "user_id").join(target, "friend_user_id").select(*schemas.EDGES.fieldNames())
        return known.unionByName(named_edges(self.open_edges, self.id_map))

    @cached_property
    def vid_edges(self) -> DataFrame:
        return stored_graph.vid_edges(self.by_user, self.id_map).unionByName(self.open_edges)

    @cached_property
    def people(self) -> DataFrame:
        return self.stored("people").where("registered OR out_degree > 0 OR in_degree > 0").select(*schemas.PEOPLE.fieldNames())

    @cached_property
    def hot_flags(self) -> DataFrame:
        return self.stored("hot_flags").where("listed > 0").select("user_id", (F.col("hot") > 0).alias("is_cached"))

    @cached_property
    def rejects(self) -> DataFrame:
        """The rows of the log this snapshot applied that were no call."""
        return self.spark.read.parquet(f"{self.folder}/rejects")

    def of_users(self, table: str, user_ids: Iterable[str]) -> DataFrame:
        """The rows of a caller's short list of users, by the clustering column: their buckets, then row groups.

        Buckets are folders and the ids reach the scan, where sorted files and bloom filters leave few row groups to read.
        """
        wanted, by = list(dict.fromkeys(user_ids)), KINDS[table].clustered_by
        if len(wanted) > SHORT_LIST:
            raise ValueError(f"more than {SHORT_LIST} users; join with the table instead")
        if not wanted:
            return self.stored(table, []).drop(BUCKET)
        numbers = self.spark.range(1).select(F.array(*[bucket_of(F.lit(user), self.buckets) for user in wanted])).first()[0]
        return self.stored(table, sorted(set(numbers))).where(F.col(by).isin(wanted)).drop(BUCKET)

    def vertices_of(self, user_ids: Iterable[str]) -> DataFrame:
        """(user_id, vertex_id) of a caller's short list of users; unknown ones have no row."""
        return self.of_users("id_map", user_ids)


def named_edges(vid_edges: DataFrame, id_map: DataFrame) -> DataFrame:
    """Vertex pairs with the user ids of their ends, NULL where a vertex is unknown."""
    source = id_map.select(F.col("vertex_id").alias("src_vid"), "user_id")
    target = id_map.select(F.col("vertex_id").alias("dst_vid"), F.col("user_id").alias("friend_user_id"))
    return vid_edges.select("src_vid", "dst_vid").join(source, "src_vid", "left").join(target, "dst_vid", "left").select(
        *schemas.EDGES.fieldNames())


def create(spark: SparkSession, root: str) -> Graph:
    """Reset: the current snapshot becomes an empty one. Older ones stay for their readers."""
    before = _current(spark, root)
    epoch = before["epoch"] + 1 if before else 0
    return _publish(spark, root, session.new_folder(spark, f"{_name(root)}-snapshot"), [], NO_BATCH, epoch, FEWEST_BUCKETS, True, HOT_THRESHOLD)


def open_graph(spark: SparkSession, root: str, bytes_per_partition: int = session.BYTES_PER_PARTITION) -> Graph:
    current = _current(spark, root)
    if current is None:
        raise ValueError(f"{root} has no snapshot")
    parts = tuple(_parts_in(spark, current["folder"]))
    sized = [spark.read.schema(KINDS[part.table].stored).parquet(part.path) for part in parts if part.table in ("by_user", "id_map")]
    own = session.tuned(spark, *sized, bytes_per_partition=bytes_per_partition)
    return Graph(own, root, current["folder"], current["number"], current["applied_batch"], current["epoch"], current["buckets"],
                 current["collapsed"], current["hot_threshold"], parts)


def fork(spark: SparkSession, graph: Graph, root: str) -> Graph:
    """Make a snapshot of one graph the current one of another. Parts never change, so nothing is copied."""
    folder = session.new_folder(spark, f"{_name(root)}-fork")
    return _publish(spark, root, folder, list(graph.parts), NO_BATCH, graph.epoch, graph.buckets, graph.collapsed, graph.hot_threshold)


def buckets_for(*sized: DataFrame) -> int:
    """Buckets for a graph of that size; a graph keeps its number until it is loaded anew."""
    return max(FEWEST_BUCKETS, -(-sum(session.planned_bytes(df) for df in sized) // BYTES_PER_BUCKET))


def import_graph(spark: SparkSession, root: str, folder: str, id_map: DataFrame, edges: DataFrame, hot_threshold: int,
                 buckets: int | None = None) -> Graph:
    """Make written tables of a graph the current snapshot: (user_id, vertex_id), and EDGES with NULL for unknown ends."""
    if not idmap.duplicate_user_ids(id_map).isEmpty():
        raise NotUnique(f"the id map below {folder} would hold a user_id twice")
    before = _current(spark, root)
    epoch = before["epoch"] + 1 if before else 0
    buckets = buckets or buckets_for(id_map, edges)
    known = F.col("user_id").isNotNull() & F.col("friend_user_id").isNotNull()
    pairs = edges.where(known).select(*PAIR)
    rows = versions.of_edges(pairs, epoch)
    steps = pairs.distinct().withColumn("step", F.lit(1).cast("long"))
    open_ = edges.where(~known).select("src_vid", "dst_vid", F.lit(1).cast("long").alias("there"))
    people = neighbourhood.people(pairs.distinct(), id_map)
    tables = {"id_map": id_map, "by_user": rows, "by_friend": rows, "open_edges": open_, "people": people,
              "digests": digest_steps(steps, buckets)}
    tables["hot_flags"] = _flag_steps(people.select("user_id", F.lit(0).cast("long").alias("was"), F.col("out_degree").alias("now")), hot_threshold)
    parts = stored_parts.side_by_side(
        partial(stored_parts.write_base, table, name, KINDS[name], buckets, f"{folder}/{name}") for name, table in tables.items())
    once = all(_holds_once(spark, [part for part in parts if part.table == name], KINDS[name]) for name in ("open_edges", "by_user"))
    return _publish(spark, root, folder, parts, NO_BATCH, epoch, buckets, once, hot_threshold)


def _holds_once(spark: SparkSession, parts: list[Part], kind: Kind) -> bool:
    """Whether a base that was just written holds each key once. Its ranges are sorted, and only digests of keys are shuffled."""
    keys = stored_parts.union([stored_parts.read_part(spark, part, kind) for part in parts])
    if keys is None:
        return True
    digest = keys.select(F.xxhash64(*kind.key).alias("key")).groupBy("key").agg(F.count("*").alias("n"))
    return digest.where("n > 1").isEmpty()


def collapsed(graph: Graph, folder: str) -> Graph:
    """The graph with each edge once. Only an import can hold one twice."""
    if graph.collapsed:
        return graph
    repeated = ("by_user", "by_friend", "open_edges")
    parts = [part for part in graph.parts if part.table not in repeated] + stored_parts.side_by_side(
        partial(stored_parts.collapse, graph.spark, graph.parts_of(name), name, KINDS[name], graph.buckets, f"{folder}/collapsed-{name}")
        for name in repeated)
    return Graph(graph.spark, graph.root, graph.folder, graph.number, graph.applied_batch, graph.epoch, graph.buckets, True,
                 graph.hot_threshold, tuple(parts))


def digest_steps(moved: DataFrame, buckets: int) -> DataFrame:
    """What pairs(user_id, friend_user_id, step) add to the digest of their bucket.

    Sums of both halves of two 64-bit hashes: the order of rows does not matter, a pair that leaves subtracts what it added.
    """
    there, back = F.xxhash64(*PAIR), F.xxhash64(*reversed(PAIR))
    half = F.lit(0xFFFFFFFF).cast("long")

    def summed(value, name):
        return F.sum(F.col("step") * value).alias(name)

    return moved.groupBy(bucket_of(F.col("user_id"), buckets).alias("part")).agg(
        F.sum("step").alias("n"), summed(there.bitwiseAND(half), "low"), summed(F.shiftrightunsigned(there, 32), "high"),
        summed(back.bitwiseAND(half), "low_back"), summed(F.shiftrightunsigned(back, 32), "high_back"))


def unequal_buckets(graph: Graph, wanted: DataFrame, buckets: int) -> list[int]:
    """The buckets of by_user whose edges differ from those of ``wanted``, by their digests. At most one number a bucket."""
    minus = graph.stored("digests").select("part", *[(-F.col(name)).alias(name) for name in _SUMS])
    plus = digest_steps(wanted.select(*PAIR, F.lit(1).cast("long").alias("step")), buckets)
    apart = plus.unionByName(minus).groupBy("part").agg(*[F.sum(name).alias(name) for name in _SUMS])
    return sorted(row["part"] for row in apart.where(" OR ".join(f"{name} <> 0" for name in _SUMS)).select("part").collect())


def degree_steps(moved: DataFrame, new_users: DataFrame) -> DataFrame:
    """What moved pairs and new users add to the table of people, one row a user."""
    none = F.lit(0).cast("long")
    ends = moved.select(F.inline(F.array(
        F.struct(F.col("user_id"), F.col("step").alias("out_degree"), none.alias("in_degree")),
        F.struct(F.col("friend_user_id").alias("user_id"), none.alias("out_degree"), F.col("step").alias("in_degree")))))
    rows = ends.withColumn("registered", F.lit(False)).unionByName(
        new_users.select("user_id", none.alias("out_degree"), none.alias("in_degree"), F.lit(True).alias("registered")))
    return rows.groupBy("user_id").agg(F.max("registered").alias("registered"), F.sum("out_degree").alias("out_degree"),
                                       F.sum("in_degree").alias("in_degree"))


def _flag_steps(degrees: DataFrame, threshold: int) -> DataFrame:
    """Steps of the flags of (user_id, was, now): numbers of friends before and after."""
    def step(least):
        return ((F.col("now") >= least).cast("long") - (F.col("was") >= least).cast("long"))

    return degrees.select("user_id", step(1).alias("listed"), step(threshold).alias("hot")).where("listed <> 0 OR hot <> 0")


def publish_changes(graph: Graph, folder: str, news: DataFrame, moved: DataFrame, new_users: DataFrame, opened: DataFrame,
                    applied_batch: int, hot_threshold: int, buckets: int) -> Graph:
    """The next snapshot: new versions, and what follows from the edges that came (+1) and went (-1).

    ``news`` (VERSIONS), ``moved`` (pair, step), ``new_users`` (ID_MAP) and ``opened`` (src_vid, dst_vid of open edges that
    have become known) are written tables. Nothing else is read but the rows of users with a step, by their buckets.
    """
    spark = graph.spark
    parts = list(graph.parts)
    came = not new_users.isEmpty()
    if came:
        check_new_users(graph, new_users, buckets)
    deltas = {"by_user": news, "by_friend": news, "digests": digest_steps(moved, buckets), "people": degree_steps(moved, new_users)}
    if came:
        deltas["id_map"] = new_users
        deltas["open_edges"] = opened.select("src_vid", "dst_vid", F.lit(-1).cast("long").alias("there"))

    def add(name, rows):
        if graph.parts_of(name):
            return stored_parts.write_delta(rows, name, KINDS[name], buckets, f"{folder}/new-{name}")
        return stored_parts.write_base(rows, name, KINDS[name], buckets, f"{folder}/{name}")

    parts += stored_parts.side_by_side(partial(add, name, rows) for name, rows in deltas.items())
    parts += add("hot_flags", _hot_steps(graph, parts, buckets, hot_threshold))
    settled = stored_parts.side_by_side(partial(
        stored_parts.settle, spark, [part for part in parts if part.table == name], name, kind, buckets, folder) for name, kind in KINDS.items())
    return _publish(spark, graph.root, folder, settled, applied_batch, graph.epoch + 1, buckets, True, hot_threshold)


def check_new_users(graph: Graph, new_users: DataFrame, buckets: int) -> None:
    """New users must be new: once each, and in none of the buckets of the id map they fall into. Other buckets are not read."""
    touched = sorted(row[0] for row in new_users.select(bucket_of(F.col("user_id"), buckets)).distinct().collect())
    known = graph.stored("id_map", touched).join(new_users.select("user_id"), "user_id", "left_semi").select("user_id")
    twice = idmap.duplicate_user_ids(new_users).select("user_id").unionByName(known).first()
    if twice:
        raise NotUnique(f"the id map would hold {twice[0]!r} twice")


def _hot_steps(graph: Graph, parts: list[Part], buckets: int, threshold: int) -> DataFrame:
    """Steps of the flags from the steps of the degrees, which ``parts`` lists last. With another threshold than before all users are judged."""
    people = KINDS["people"]
    steps = [part for part in parts if part.table == "people" and part not in graph.parts]
    new = stored_parts.read(graph.spark, steps, people).select("user_id", F.col("out_degree").alias("step"))
    if threshold != graph.hot_threshold:
        old = graph.stored("people").select("user_id", F.col("out_degree").alias("was"))
        both = old.unionByName(new, allowMissingColumns=True).groupBy("user_id").agg(
            F.coalesce(F.sum("was"), F.lit(0)).alias("was"), F.coalesce(F.sum("step"), F.lit(0)).alias("step"))
        flagged = graph.stored("hot_flags").select("user_id", "listed", "hot")
        now = both.select("user_id", (F.col("was") + F.col("step")).alias("now"))
        zero = F.lit(0).cast("long")
        step = [((F.col("now") >= least).cast("long") - F.coalesce(F.col(name), zero)).alias(name) for name, least in (("listed", 1), ("hot", threshold))]
        return now.join(flagged, "user_id", "left").select("user_id", *step).where("listed <> 0 OR hot <> 0")
    moving = new.where("step <> 0")
    touched = sorted(row[0] for row in moving.select(bucket_of(F.col("user_id"), buckets)).distinct().collect())
    old = graph.stored("people", touched).select("user_id", F.col("out_degree").alias("was")).join(moving.select("user_id"), "user_id", "left_semi")
    was = F.coalesce("was", F.lit(0).cast("long"))
    return _flag_steps(moving.join(old, "user_id", "left").select("user_id", was.alias("was"), (was + F.col("step")).alias("now")), threshold)


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete the files of parts that none of the last ``keep`` snapshots lists; returns their paths.

    Readers of a kept snapshot are spared. Forks list the same parts: vacuum a root only if no other root was forked from a
    snapshot that goes, or name the forks' roots in the call for it.
    """
    if keep < 1:
        raise ValueError("the current snapshot must be kept")
    rows = _pointer(spark, root).orderBy(F.col("number").desc()).collect()
    listed = [{part.path for part in _parts_in(spark, row["folder"])} for row in rows]
    gone = []
    for path in sorted(set().union(*listed[keep:]) - set().union(*listed[:keep])):
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        if target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True):
            gone.append(path)
    return gone


def _parts_in(spark: SparkSession, folder: str) -> list[Part]:
    """The parts a snapshot lists, a row each."""
    rows = spark.read.schema(schemas.PARTS).parquet(f"{folder}/parts").collect()
    return [Part(row["table"], row["path"], row["level"], row["n_rows"], None if row["buckets"] is None else tuple(row["buckets"])) for row in rows]


def _name(root: str) -> str:
    return root.rstrip("/").rsplit("/", 1)[-1]


def _pointer(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(schemas.SNAPSHOTS).option("ignoreMissingFiles", "true").parquet(f"{root}/snapshots")


def _current(spark: SparkSession, root: str):
    try:
        return _pointer(spark, root).orderBy(F.col("number").desc()).first()
    except Exception as error:
        if "PATH_NOT_FOUND" in str(error):
            return None
        raise


def _publish(spark: SparkSession, root: str, folder: str, parts: list[Part], applied_batch: int, epoch: int, buckets: int,
             collapsed: bool, hot_threshold: int) -> Graph:
    rows = [{"table": part.table, "path": part.path, "level": part.level, "n_rows": part.n_rows,
             "buckets": None if part.buckets is None else list(part.buckets)} for part in parts]
    spark.createDataFrame(pa.Table.from_pylist(rows, to_arrow_schema(schemas.PARTS)), schemas.PARTS).coalesce(1).write.parquet(f"{folder}/parts")
    before = _current(spark, root)
    row = {"number": before["number"] + 1 if before else 0, "folder": folder, "applied_batch": applied_batch, "epoch": epoch,
           "buckets": buckets, "collapsed": collapsed, "hot_threshold": hot_threshold}
    pointer = pa.Table.from_pylist([row], to_arrow_schema(schemas.SNAPSHOTS))
    spark.createDataFrame(pointer, schemas.SNAPSHOTS).coalesce(1).write.mode("append").parquet(f"{root}/snapshots")
    return open_graph(spark, root)
