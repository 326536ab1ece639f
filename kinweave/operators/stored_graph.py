"""The stored graph in vertex ids, and how it differs from the roster."""

from pyspark.sql import DataFrame, functions as F


def vid_edges(friendships: DataFrame, id_map: DataFrame) -> DataFrame:
    """Friendships as vertex id pairs; both ends must be in the id map."""
    source = id_map.select("user_id", F.col("vertex_id").alias("src_vid"))
    target = id_map.select(F.col("user_id").alias("friend_user_id"), F.col("vertex_id").alias("dst_vid"))
    return friendships.join(source, "user_id").join(target, "friend_user_id").select("src_vid", "dst_vid")


def registered_edges(graph_edges: DataFrame, id_map: DataFrame) -> DataFrame:
    """Stored edges that leave a vertex of the id map; the far end may be unknown."""
    known = id_map.select(F.col("vertex_id").alias("src_vid"))
    return graph_edges.select("src_vid", "dst_vid").join(known, "src_vid", "left_semi")


def neighbours(seeds: DataFrame, graph_edges: DataFrame, id_map: DataFrame) -> DataFrame:
    """The vertices every seed user has an edge to; a repeated seed counts once."""
    asked = id_map.join(seeds.select("user_id").distinct(), "user_id", "left_semi")
    source = asked.select("user_id", F.col("vertex_id").alias("src_vid"))
    return graph_edges.join(source, "src_vid").select("user_id", F.col("dst_vid").alias("friend_vid"))


def graph_friendships(graph_edges: DataFrame, id_map: DataFrame) -> DataFrame:
    """Stored edges as user id pairs; an edge with an unknown end is not visible."""
    source = id_map.select(F.col("vertex_id").alias("src_vid"), "user_id")
    target = id_map.select(F.col("vertex_id").alias("dst_vid"), F.col("user_id").alias("friend_user_id"))
    return graph_edges.join(source, "src_vid").join(target, "dst_vid").select("user_id", "friend_user_id")


def edge_diff(stored: DataFrame, wanted: DataFrame) -> DataFrame:
    """The unmatched rows of a full outer join of two edge sets on the whole pair.

    As both sides are sets keyed by the pair, the join is one grouping of their union:
    one shuffle, a hash aggregate with two flags, no sort and no hot key.
    """
    def side(edges, in_stored):
        return edges.select("user_id", "friend_user_id", F.lit(in_stored).alias("in_stored"))

    both = side(stored, True).unionByName(side(wanted, False))
    pairs = both.groupBy("user_id", "friend_user_id").agg(
        F.max("in_stored").alias("in_stored"), F.min("in_stored").alias("only_stored")
    )
    stored_only, wanted_only = F.col("only_stored"), ~F.col("in_stored")
    return pairs.where(stored_only | wanted_only).select(
        F.when(stored_only, F.col("user_id")).alias("stored_user_id"),
        F.when(stored_only, F.col("friend_user_id")).alias("stored_friend_user_id"),
        F.when(wanted_only, F.col("user_id")).alias("wanted_user_id"),
        F.when(wanted_only, F.col("friend_user_id")).alias("wanted_friend_user_id"),
    )


def stale_edges(diff: DataFrame) -> DataFrame:
    return diff.where(F.col("stored_user_id").isNotNull()).select(
        F.col("stored_user_id").alias("user_id"), F.col("stored_friend_user_id").alias("friend_user_id")
    )


def missing_edges(diff: DataFrame) -> DataFrame:
    return diff.where(F.col("wanted_user_id").isNotNull()).select(
        F.col("wanted_user_id").alias("user_id"), F.col("wanted_friend_user_id").alias("friend_user_id")
    )
