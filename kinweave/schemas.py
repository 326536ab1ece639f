"""Explicit schemas of every stored table."""

from pyspark.sql import types as T

ROSTER = T.StructType([
    T.StructField("rosterID", T.LongType()),
    T.StructField("username", T.StringType()),
    T.StructField("loginAccount", T.StringType()),
    T.StructField("userID", T.StringType()),
    T.StructField("sub", T.IntegerType()),
])

RELATION = T.StructType([
    T.StructField("rosterId", T.LongType()),
    T.StructField("username", T.StringType()),
    T.StructField("loginAccount", T.StringType()),
    T.StructField("userId", T.StringType()),
])

USERS = T.StructType([T.StructField("user_id", T.StringType())])

ID_MAP = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("vertex_id", T.StringType()),
])

FRIENDSHIPS = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("friend_user_id", T.StringType()),
])

VID_EDGES = T.StructType([
    T.StructField("src_vid", T.StringType()),
    T.StructField("dst_vid", T.StringType()),
])

EDGES = T.StructType([
    T.StructField("src_vid", T.StringType()),
    T.StructField("dst_vid", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("friend_user_id", T.StringType()),
])

HOT_FLAGS = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("is_cached", T.BooleanType()),
])

REQUESTS = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("candidate_id", T.StringType()),
])

CHANGES = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("friend_user_id", T.StringType()),
    T.StructField("op", T.StringType()),
    T.StructField("seq", T.LongType()),
])

PEOPLE = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("registered", T.BooleanType()),
    T.StructField("out_degree", T.LongType()),
    T.StructField("in_degree", T.LongType()),
])

VERSIONS = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("friend_user_id", T.StringType()),
    T.StructField("forced", T.LongType()),
    T.StructField("upto", T.LongType()),
    T.StructField("added", T.LongType()),
    T.StructField("deleted", T.LongType()),
])

OPEN_EDGES = T.StructType([
    T.StructField("src_vid", T.StringType()),
    T.StructField("dst_vid", T.StringType()),
    T.StructField("there", T.LongType()),
])

FLAGS = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("listed", T.LongType()),
    T.StructField("hot", T.LongType()),
])

DIGESTS = T.StructType([
    T.StructField("part", T.IntegerType()),
    T.StructField("n", T.LongType()),
    T.StructField("low", T.LongType()),
    T.StructField("high", T.LongType()),
    T.StructField("low_back", T.LongType()),
    T.StructField("high_back", T.LongType()),
])

PARTS = T.StructType([
    T.StructField("table", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("level", T.IntegerType()),
    T.StructField("n_rows", T.LongType()),
    T.StructField("buckets", T.ArrayType(T.IntegerType())),
])

SNAPSHOTS = T.StructType([
    T.StructField("number", T.LongType()),
    T.StructField("folder", T.StringType()),
    T.StructField("applied_batch", T.LongType()),
    T.StructField("epoch", T.LongType()),
    T.StructField("buckets", T.IntegerType()),
    T.StructField("collapsed", T.BooleanType()),
    T.StructField("hot_threshold", T.LongType()),
])
