"""Users with many friends."""

from pyspark.sql import DataFrame, functions as F


def out_degrees(friendships: DataFrame) -> DataFrame:
    return friendships.groupBy("user_id").agg(F.count("*").alias("n_friends"))


def hot_flags(people: DataFrame, threshold: int) -> DataFrame:
    """Whether a user has at least ``threshold`` friends, for every user with a friend, from the table of people."""
    return people.where(F.col("out_degree") > 0).select("user_id", (F.col("out_degree") >= threshold).alias("is_cached"))


def flagged_users(flags: DataFrame) -> DataFrame:
    return flags.where(F.col("is_cached")).select("user_id")


def hot_users(friendships: DataFrame, threshold: int) -> DataFrame:
    """All users with at least ``threshold`` friends, in no order."""
    return out_degrees(friendships).where(F.col("n_friends") >= threshold)


def hot_users_page(friendships: DataFrame, threshold: int, size: int, offset: int = 0) -> DataFrame:
    """A page of the hot users, most friends first."""
    return hot_users(friendships, threshold).orderBy(F.col("n_friends").desc(), "user_id").offset(offset).limit(size)
