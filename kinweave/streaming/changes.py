"""Online friendship changes as a stream.

The stream appends micro-batches to a change log, one folder a batch, so a batch that is repeated
after a failure replaces itself. A reader applies the log to the last snapshot. From time to
time the log is folded into the next snapshot, which notes the last batch it holds; readers of
that snapshot begin behind it. The snapshot keeps the last calls of each pair, so a call that comes late, behind a compaction,
counts by its seq and not by its arrival.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from kinweave import schemas
from kinweave.operators import versions
from kinweave.operators.changes import apply_changes
from kinweave.plans import jobs, store

BATCH = "batch"


def log_changes(changes: DataFrame, log: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append a streaming DataFrame of changes to the log; ``trigger`` as in ``writeStream.trigger``."""
    rows = changes.select(*schemas.CHANGES.fieldNames())

    def append(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{log}/{BATCH}={number}")

    writer = rows.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def read_log(spark: SparkSession, log: str, after: int = store.NO_BATCH) -> DataFrame:
    """The changes of the batches behind ``after``; whole folders are skipped. With the column ``batch``."""
    schema = schemas.CHANGES.simpleString()[len("struct<"):-1].replace(":", " ")
    return spark.read.schema(f"{schema}, {BATCH} long").parquet(log).where(F.col(BATCH) > after)


def current_edges(edges: DataFrame, log: DataFrame) -> DataFrame:
    """The edges after a whole log, from edges that no call has touched before."""
    return apply_changes(edges, log)


def edges_behind(graph: store.Graph, log: DataFrame) -> DataFrame:
    """The edges after what the log holds behind a snapshot, late calls included."""
    return versions.apply_changes(graph.versions, log)


def compact(spark: SparkSession, log: str, root: str, **options) -> store.Graph:
    """Fold the batches that the current snapshot does not hold into the next one."""
    graph = store.open_graph(spark, root)
    new = read_log(spark, log, graph.applied_batch)
    last = new.agg(F.max(BATCH)).first()[0]
    if last is None:
        return graph
    return jobs.apply_changes(spark, new.where(F.col(BATCH) <= last), root, applied_batch=last, **options)
