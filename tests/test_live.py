"""Calls judged on a stream give the edges of the whole log, under replay, reorder and restart."""

import random

import pytest

from kinweave import schemas
from kinweave.operators import versions
from kinweave.streaming.live import ACCEPTED, LATE, REPEATED, accepted, log_judged, read_judged
from test_versions import random_log, rows, whole_log


@pytest.fixture
def live(spark, tmp_path):
    source, log, checkpoint = (str(tmp_path / name) for name in ("source", "log", "checkpoint"))

    def arrive(*calls, **options):
        spark.createDataFrame(list(calls), schemas.CHANGES).coalesce(1).write.mode("append").parquet(source)
        log_judged(spark.readStream.schema(schemas.CHANGES).parquet(source), log, checkpoint, **options).awaitTermination()
    return log, arrive


def test_each_call_gets_its_verdict_and_state_outlives_a_restart(spark, live):
    log, arrive = live
    arrive(("a", "b", "add", 10), ("a", "c", "add", 1), ("a", None, "add", 1), ("a", "b", "block", 11))
    arrive(("a", "b", "delete", 5), ("a", "b", "add", 10), ("a", "c", "delete", 1), ("x", "y", "delete", 3))
    found = {(*row[:4],): row.verdict for row in read_judged(spark, log).where("batch = 1").collect()}
    assert found == {("a", "b", "delete", 5): LATE, ("a", "b", "add", 10): REPEATED, ("a", "c", "delete", 1): ACCEPTED,
                     ("x", "y", "delete", 3): ACCEPTED}
    assert sorted(row.verdict for row in read_judged(spark, log).where("batch = 0").collect()) == [ACCEPTED, ACCEPTED, "no user", "unknown op"]


def test_replayed_and_reordered_calls_give_the_edges_of_the_whole_log(spark, make, live):
    rng = random.Random(2)
    pairs = [(a, b) for a in "abcde" for b in "abcde" if a != b]
    edges, calls = rng.sample(pairs, 8), random_log(rng, pairs, 150)
    log, arrive = live
    for part in (calls[100:], calls[:60], calls[40:110]):
        arrive(*rng.sample(part, len(part)))
    found = versions.apply_changes(versions.of_edges(make(schemas.FRIENDSHIPS, *edges)), accepted(spark, log))
    assert rows(found) == whole_log(edges, calls)
    assert accepted(spark, log).count() < len(calls)


def test_state_expires_and_edges_do_not_depend_on_it(spark, make, live):
    log, arrive = live
    arrive(("a", "b", "add", 10), ttl_ms=1)
    arrive(("a", "b", "delete", 5), ttl_ms=1)
    assert [row.verdict for row in read_judged(spark, log).where("batch = 1").collect()] == [ACCEPTED]
    assert rows(versions.apply_changes(versions.of_edges(make(schemas.FRIENDSHIPS)), accepted(spark, log))) == [("a", "b")]
