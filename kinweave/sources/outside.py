"""Sink for a store that Spark has no writer for."""

from itertools import batched

from pyspark.sql import DataFrame


def write_partitions(df: DataFrame, open_client, send, batch_rows: int = 1000) -> None:
    """Hand rows to an outside store with one client per partition, in batches.

    ``open_client()`` runs once per partition and its result is closed at the end;
    ``send(client, rows)`` gets up to ``batch_rows`` rows and must be safe to repeat, as a
    lost task runs again.
    """
    def deliver(rows):
        client = open_client()
        try:
            for batch in batched(rows, batch_rows):
                send(client, batch)
        finally:
            client.close()

    df.foreachPartition(deliver)
