"""Questions of one user about a list of others, and single changes."""

from collections.abc import Iterable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from kinweave import schemas
from kinweave.operators import changes, neighbourhood, versions
from kinweave.plans import store

# A caller's list of at most this many pairs touches at most twice as many users, so what
# follows from it may be broadcast.
SHORT_LIST = 10_000


def requests_of(spark: SparkSession, user_id: str, candidate_ids: Iterable[str]) -> DataFrame:
    """The caller's list as requests. From Arrow, so that Spark knows its size when it plans joins."""
    others = pa.array(list(candidate_ids), pa.string())
    users = pa.array([user_id] * len(others), pa.string())
    return spark.createDataFrame(pa.table({"user_id": users, "candidate_id": others}))


@dataclass(frozen=True)
class FriendGraph:
    """Edges clustered both ways and people of a graph; every question first narrows them to whom it concerns.

    An edge matters only if it leaves the asking user or enters a candidate. The user's own edges are a
    filter that reaches the scan of ``by_user``; those into candidates are a semi join on
    ``by_friend``. The caller's lists pass through the driver, where they come from.
    """

    by_user: DataFrame
    by_friend: DataFrame
    people: DataFrame
    graph: store.Graph | None = None

    @classmethod
    def open(cls, spark: SparkSession, root: str) -> "FriendGraph":
        graph = store.open_graph(spark, root)
        return cls(graph.by_user, graph.by_friend, graph.people, graph)

    def friend_levels(self, user_id: str, candidate_ids: Iterable[str]) -> DataFrame:
        return self._ask(neighbourhood.friend_levels, user_id, candidate_ids)

    def common_friend_count(self, user_id: str, candidate_ids: Iterable[str]) -> DataFrame:
        return self._ask(neighbourhood.common_friend_count, user_id, candidate_ids)

    def common_friends(self, user_id: str, candidate_ids: Iterable[str]) -> DataFrame:
        return self._ask(neighbourhood.common_friends, user_id, candidate_ids)

    def common_friends_pair(self, user_id: str, other_id: str) -> DataFrame:
        return self._ask(neighbourhood.common_friends_pair, user_id, [other_id])

    def _ask(self, question, user_id, candidate_ids):
        requests = requests_of(self.by_user.sparkSession, user_id, candidate_ids)
        return question(requests, *self.narrowed(user_id, requests))

    def narrowed(self, user_id: str, requests: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Edges and people that can matter to the requests of the user."""
        asked = requests.select(F.col("candidate_id").alias("friend_user_id"))
        own = self.by_user.where(F.col("user_id") == user_id)
        if self.graph:  # only the user's bucket
            own = versions.current(self.graph.of_users("by_user", [user_id]))
        into = self.by_friend.where(F.col("user_id") != user_id).join(asked, "friend_user_id", "left_semi")
        named = requests.select(F.explode(F.array("user_id", "candidate_id")).alias("user_id"))
        return own.unionByName(into), self.people.join(named, "user_id", "left_semi")

    def with_changes(self, adds: Iterable[tuple[str, str]] = (), deletes: Iterable[tuple[str, str]] = ()) -> "FriendGraph":
        """The graph after adding and deleting the given (user, friend) pairs; deletes come last.

        For a short list no table of the graph is shuffled. Nothing is stored; see ``jobs.apply_changes``.
        """
        rows = [(*pair, "add", 1) for pair in adds] + [(*pair, "delete", 2) for pair in deletes]
        records = [dict(zip(schemas.CHANGES.fieldNames(), row)) for row in rows]
        log = self.by_user.sparkSession.createDataFrame(pa.Table.from_pylist(records, to_arrow_schema(schemas.CHANGES)), schemas.CHANGES)
        small = F.broadcast if len(rows) <= SHORT_LIST else lambda df: df
        touched, added = changes.valid(log).select(*changes.PAIR), changes.last_adds(log)

        def changed(edges):
            return edges.join(small(touched), changes.PAIR, "left_anti").unionByName(added)

        there = self.by_user.join(small(touched), changes.PAIR, "left_semi").withColumn("there", F.lit(True))
        after = touched.distinct().join(small(added.withColumn("after", F.lit(True))), changes.PAIR, "left").join(
            small(there), changes.PAIR, "left")
        step = F.coalesce("after", F.lit(False)).cast("long") - F.coalesce("there", F.lit(False)).cast("long")
        moved = after.select(*changes.PAIR, step.alias("step"))
        degrees = moved.select(F.col("user_id"), F.col("step").alias("out_step"), F.lit(0).cast("long").alias("in_step")).unionByName(
            moved.select(F.col("friend_user_id").alias("user_id"), F.lit(0).cast("long").alias("out_step"), F.col("step").alias("in_step")))
        new = changes.added_users(log).withColumn("new", F.lit(True))
        steps = degrees.groupBy("user_id").agg(F.sum("out_step").alias("out_step"), F.sum("in_step").alias("in_step")).join(
            new, "user_id", "left")
        known = self.people.join(small(steps.select("user_id")), "user_id", "left_semi").select("user_id", F.lit(True).alias("listed"))
        zero = F.lit(0).cast("long")
        people = self.people.join(small(steps), "user_id", "left").select(
            "user_id", (F.col("registered") | F.coalesce("new", F.lit(False))).alias("registered"),
            (F.col("out_degree") + F.coalesce("out_step", zero)).alias("out_degree"),
            (F.col("in_degree") + F.coalesce("in_step", zero)).alias("in_degree"))
        unlisted = steps.join(small(known), "user_id", "left").where(F.col("listed").isNull() & F.col("new")).select(
            "user_id", F.lit(True).alias("registered"), F.col("out_step").alias("out_degree"), F.col("in_step").alias("in_degree"))
        return FriendGraph(changed(self.by_user), changed(self.by_friend), people.unionByName(unlisted))
