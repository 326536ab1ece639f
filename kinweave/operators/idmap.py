"""The map from user ids to vertex ids, and operators on keyed tables."""

from pyspark.sql import DataFrame, functions as F


def with_vertex_ids(users: DataFrame) -> DataFrame:
    """A vertex id per user: a digest, so that it is the same in every run and task."""
    return users.select("user_id", F.md5("user_id").alias("vertex_id"))


def missing_users(users: DataFrame, id_map: DataFrame) -> DataFrame:
    return insert_candidates(users.select("user_id"), id_map, ["user_id"])


def insert_candidates(rows: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """The rows an insert-if-absent has to add: each new key once, none that exists."""
    return rows.dropDuplicates(keys).join(existing.select(*keys), keys, "left_anti")


def latest_documents(updates: DataFrame) -> DataFrame:
    """The last version of every document, by seq.

    An aggregate and not a window: versions collapse before the shuffle, so a document
    that holds a large share of the updates reaches its task as a few rows.
    """
    last = F.max(F.struct("seq", "vertex_id"))
    return updates.groupBy("user_id").agg(last.alias("last")).select("user_id", "last.vertex_id")


def upsert(id_map: DataFrame, updates: DataFrame) -> DataFrame:
    touched = updates.select("user_id").distinct()
    untouched = id_map.select("user_id", "vertex_id").join(touched, "user_id", "left_anti")
    return untouched.unionByName(latest_documents(updates))


def delete_documents(id_map: DataFrame, keys: DataFrame) -> DataFrame:
    return id_map.join(keys.select("user_id").distinct(), "user_id", "left_anti")


def resolve_left(ids: DataFrame, id_map: DataFrame) -> DataFrame:
    """One row per input id, vertex id NULL where the id is unknown."""
    return ids.select("user_id").join(id_map.select("user_id", "vertex_id"), "user_id", "left")


def resolve_inner(ids: DataFrame, id_map: DataFrame) -> DataFrame:
    """One row per known input id; unknown ids fall away."""
    return ids.select("user_id").join(id_map.select("user_id", "vertex_id"), "user_id")


def duplicate_user_ids(users: DataFrame) -> DataFrame:
    """Users that break the uniqueness of user_id, with their number of rows."""
    return users.groupBy("user_id").agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def duplicate_edges(edges: DataFrame) -> DataFrame:
    """Ordered pairs that occur more than once, with their number of rows."""
    return (
        edges.groupBy("user_id", "friend_user_id").agg(F.count("*").alias("n_rows")).where("n_rows > 1")
    )
