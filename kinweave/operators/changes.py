"""Adding and deleting friendships in bulk.

``changes(user_id, friend_user_id, op, seq)`` is a log of 'add' and 'delete' calls. For a
set of edges only the last call per pair counts; for users every add counts, as it creates
both ends and a later delete of the edge leaves them in place. A row with another op, or with
NULL in any column, is no call: it changes nothing and ``rejected`` reports it.
"""

from pyspark.sql import Column, DataFrame, functions as F

PAIR = ["user_id", "friend_user_id"]
CALLS = ("add", "delete")


def _reason() -> Column:
    return (
        F.when(F.col("user_id").isNull() | F.col("friend_user_id").isNull(), "no user")
        .when(F.col("op").isNull() | ~F.col("op").isin(*CALLS), "unknown op")
        .when(F.col("seq").isNull(), "no seq")
    )


def valid(changes: DataFrame) -> DataFrame:
    return changes.where(_reason().isNull()).select(*PAIR, "op", "seq")


def rejected(changes: DataFrame) -> DataFrame:
    """The rows that are no call, with the first reason."""
    return changes.select(*PAIR, "op", "seq", _reason().alias("reason")).where(F.col("reason").isNotNull())


def calls(changes: DataFrame) -> DataFrame:
    """(pair, added, deleted) of every valid row: its seq in the column of its op."""
    def seq_of(op):
        return F.when(F.col("op") == op, F.col("seq"))

    return valid(changes).select(*PAIR, seq_of("add").alias("added"), seq_of("delete").alias("deleted"))


def ends_added() -> Column:
    """Whether the last call of a pair, from its largest ``added`` and ``deleted``, is an add. At equal seq the delete wins."""
    return F.col("added").isNotNull() & F.coalesce(F.col("added") > F.col("deleted"), F.lit(True))


def is_called() -> Column:
    return F.col("added").isNotNull() | F.col("deleted").isNotNull()


def last_adds(changes: DataFrame) -> DataFrame:
    """Pairs whose last change is an add.

    Two numeric maxima keep this a hash aggregate that collapses before the shuffle.
    """
    last = calls(changes).groupBy(*PAIR).agg(F.max("added").alias("added"), F.max("deleted").alias("deleted"))
    return last.where(ends_added()).select(*PAIR)


def apply_changes(edges: DataFrame, changes: DataFrame) -> DataFrame:
    """The edge set after all changes: untouched pairs stay, last adds are in.

    One grouping of edges and calls on the pair, of numbers only, so a hash aggregate.
    """
    stored = edges.select(*PAIR, F.lit(True).alias("stored"), F.lit(None).cast("long").alias("added"),
                          F.lit(None).cast("long").alias("deleted"))
    called = calls(changes).select(*PAIR, F.lit(False).alias("stored"), "added", "deleted")
    last = stored.unionByName(called).groupBy(*PAIR).agg(
        F.max("stored").alias("stored"), F.max("added").alias("added"), F.max("deleted").alias("deleted"))
    return last.where(F.when(is_called(), ends_added()).otherwise(F.col("stored"))).select(*PAIR)


def delete_edges(edges: DataFrame, deletions: DataFrame) -> DataFrame:
    """Drop the listed ordered pairs; unknown pairs change nothing, nor does the reverse edge go."""
    return edges.select(*PAIR).join(deletions.select(*PAIR).distinct(), PAIR, "left_anti")


def added_users(changes: DataFrame) -> DataFrame:
    """Both ends of every valid add, each once."""
    adds = valid(changes).where(F.col("op") == "add")
    return adds.select(F.explode(F.array(*PAIR)).alias("user_id")).distinct()


def users_after_changes(users: DataFrame, changes: DataFrame) -> DataFrame:
    return users.select("user_id").unionByName(added_users(changes)).distinct()
