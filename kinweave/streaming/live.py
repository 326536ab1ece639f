"""Calls judged as they arrive: keyed state holds the last call of each pair.

A call is accepted if it is behind the pair's last accepted call (by seq, at equal seq a delete behind an add); otherwise
it is late or repeated and changes nothing. Rows that are no call are rejected with their reason. Each micro-batch is one folder
of the log with all its rows and their verdict, replaced if the batch is repeated; state and folder are of the same batch, so
a restarted or replayed stream gives the same edges.

The state of a pair is one seq and one op, whatever the number of its calls, which pass through one by one. It expires after
``ttl`` without a call, if one is given. Then an older call may be accepted again; the versions of the stored graph still
know the newer one, so edges never depend on the expiry.

The state lives in RocksDB, which ``session.build_session`` and ``session.tuned`` choose.
"""

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from kinweave import schemas
from kinweave.operators import changes
from kinweave.streaming.changes import BATCH

ACCEPTED, LATE, REPEATED = "accepted", "late", "repeated"
JUDGED = "user_id string, friend_user_id string, op string, seq long, verdict string"


class LastCall(StatefulProcessor):
    """Judges the calls of one pair against the last one accepted."""

    def __init__(self, ttl_ms: int | None = None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._last = handle.getValueState("last", "seq long, op string", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        before = self._last.get()
        last = (before[0], before[1] == "delete") if before else None
        for row in rows:
            call = (row.seq, row.op == "delete")
            if last is None or call > last:
                last, verdict = call, ACCEPTED
            else:
                verdict = REPEATED if call == last else LATE
            yield Row(user_id=key[0], friend_user_id=key[1], op=row.op, seq=row.seq, verdict=verdict)
        self._last.update((last[0], "delete" if last[1] else "add"))

    def close(self) -> None:
        pass


def judged(calls: DataFrame, ttl_ms: int | None = None) -> DataFrame:
    """A stream of calls with the verdict on each."""
    # the worker that sets a processor up gets no files of the session, so the class travels as a value
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    keyed = changes.valid(calls).groupBy(*changes.PAIR)
    found = keyed.transformWithState(LastCall(ttl_ms), JUDGED, "Append", "processingTime" if ttl_ms else "none")
    return found.unionByName(changes.rejected(calls).withColumnRenamed("reason", "verdict"))


def log_judged(calls: DataFrame, log: str, checkpoint: str, ttl_ms: int | None = None, **trigger) -> StreamingQuery:
    """Append judged calls to a log, one folder a micro-batch and in it one a verdict; ``trigger`` as in ``writeStream.trigger``."""
    def append(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").partitionBy("verdict").parquet(f"{log}/{BATCH}={number}")

    writer = judged(calls, ttl_ms).writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def read_judged(spark: SparkSession, log: str) -> DataFrame:
    """All judged calls: CHANGES with ``batch`` and ``verdict``, which are folders."""
    schema = schemas.CHANGES.simpleString()[len("struct<"):-1].replace(":", " ")
    return spark.read.schema(f"{schema}, {BATCH} long, verdict string").parquet(log)


def accepted(spark: SparkSession, log: str) -> DataFrame:
    return read_judged(spark, log).where(F.col("verdict") == ACCEPTED)
