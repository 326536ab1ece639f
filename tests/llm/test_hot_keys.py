"""Joins on a hot host and a hot band are split: with broadcasts off, AQE finds a plain shuffle on both sides."""

import re

import pytest
from pyspark.sql import functions as F

from kinweave import session as sessions
from kinweave.llm import neardup, quality

ROWS = 30_000
FORCE_SMALL_SCALE = sessions.ADAPTIVE | {
    "spark.sql.shuffle.partitions": "16",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.fixture(scope="module")
def session(spark):
    own = spark.newSession()
    for key, value in FORCE_SMALL_SCALE.items():
        own.conf.set(key, value)
    return own


def joins(df):
    """The equi-join keys of the plan as run, with whether a hot key was split there."""
    execution = df._jdf.queryExecution()
    execution.executedPlan().execute().count()
    final = re.sub(r"#\d+L?", "", execution.executedPlan().toString().split("Initial Plan")[0])
    return {keys: bool(split) for split, keys in re.findall(r"SortMergeJoin(\(skew=true\))? \[([\w, ]+)\]", final)}


def test_a_hot_host_is_split(session):
    number = F.col("id")
    documents = session.range(ROWS).repartition(8).select(
        number.alias("doc_id"), F.when(number % 3 == 0, F.lit("hot.example")).otherwise(F.concat(F.lit("h"), number % 9973)).alias("source"),
        F.when(number % 2 == 0, F.concat(F.lit("a text of ten words and more that stands well "), number, F.lit(" by itself"))).otherwise(
            F.lit("short")).alias("text"))
    found = quality.judge(documents)
    assert joins(found)["source"]
    assert found.count() == ROWS


def test_a_hot_band_is_split(session, monkeypatch):
    """A third of all sets share a band with each other and nothing else."""
    number = F.col("id")
    nodes = session.range(ROWS).repartition(8).select(
        number.alias("node"), F.lit(10).cast("long").alias("n"), F.array(F.xxhash64(number, F.lit(1))).alias("planes"),
        F.array(F.when(number % 3 == 0, F.lit(7).cast("long")).otherwise(F.xxhash64(number % 9973))).alias("bands"))
    seen = {}

    def recorded(df, label, plain=neardup.written):
        if label in ("minhash-buckets", "minhash-named"):
            seen[label] = joins(df)
        return plain(df, label)

    monkeypatch.setattr(neardup, "written", recorded)
    monkeypatch.setattr(neardup, "estimate", lambda a, b: F.lit(0.0))
    monkeypatch.setattr(neardup, "_estimated_links", lambda table, percent, least: ([], []))
    neardup.find_families(nodes, 80).count()
    assert seen["minhash-buckets"]["band"]
