"""From roster rows to users and directed friendships."""

from pyspark.sql import DataFrame, functions as F

from kinweave.sources.roster import CONFIRMED_SUB


def relation(roster: DataFrame) -> DataFrame:
    """Confirmed rows with a known friend that do not list the owner's own account."""
    return roster.where(
        (F.col("sub") == CONFIRMED_SUB)
        & F.col("userID").isNotNull()
        & (F.col("username") != F.col("loginAccount"))
    ).select(
        F.col("rosterID").alias("rosterId"), "username", "loginAccount", F.col("userID").alias("userId")
    )


def max_roster_id(roster: DataFrame) -> DataFrame:
    return roster.agg(F.max("rosterID").alias("max_roster_id"))


def users(relation: DataFrame) -> DataFrame:
    return relation.select(F.col("userId").alias("user_id")).distinct()


def owner_friend_pairs(relation: DataFrame) -> DataFrame:
    """One row per roster row and user id of its owner; pairs may repeat.

    A row's owner is known by account only. Its user ids are those under which any row
    lists that account; an account nobody lists has none and its rows fall away.
    The accounts are made distinct first, so that the join fans out per user id and not
    per roster row.
    """
    accounts = relation.select(F.col("loginAccount").alias("username"), F.col("userId").alias("user_id")).distinct()
    listed = relation.select("username", F.col("userId").alias("friend_user_id"))
    return listed.join(accounts, "username").select("user_id", "friend_user_id")


def friendships(relation: DataFrame) -> DataFrame:
    """Directed edges owner -> friend, each pair once."""
    return owner_friend_pairs(relation).distinct()
