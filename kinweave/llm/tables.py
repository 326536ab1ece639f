"""Helpers the operators share: batches of texts, tables in the shared folder, the held-out fold."""

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Hashable, Iterator
from pathlib import Path
from weakref import WeakSet

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

BATCH_ROWS = 2000
BATCH_BYTES = 8 << 20

_shipped: WeakSet = WeakSet()
_caches: dict[str, dict[Hashable, dict]] = {}


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package: once a Spark context it is sent to the executors as an archive."""
    context = spark.sparkContext
    if context in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="llm-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as target:
        for source in sorted(package.rglob("*.py")):
            target.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context)


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; it must be set."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        raise ValueError("set spark.checkpoint.dir to a folder shared by driver and executors")
    return named.rstrip("/")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a new Parquet table in the shared folder. The files cut the lineage and outlive executors."""
    path = f"{shared_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema])
    return df.sparkSession.read.schema(schema).parquet(path)


def held_out(doc_id: Column) -> Column:
    """True for the fold no model may learn labels from. A null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def drawn(share: float, *columns: Column) -> Column:
    """True for a share of all rows, by the 64 bits of a hash of ``columns``."""
    return F.lit(True) if share >= 1 else F.xxhash64(*columns) < F.lit(int(share * 2.0 ** 64) - 2 ** 63)


def small_batches(batch: pa.RecordBatch, most_rows: int = BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    """Runs of at most ``most_rows`` rows and about BATCH_BYTES of data; a longer row stands alone."""
    waiting = [batch.slice(at, most_rows) for at in reversed(range(0, batch.num_rows, most_rows))]
    while waiting:
        part = waiting.pop()
        if part.num_rows > 1 and part.nbytes > BATCH_BYTES:
            half = part.num_rows // 2
            waiting += [part.slice(half), part.slice(0, half)]
        else:
            yield part


def worker_cache(name: str, owner: Hashable = None) -> dict:
    """What an operator keeps between the tasks of a Python worker, by ``owner``: whatever its content depends on.

    The caches of other operators are emptied, so a worker holds those of one at a time.
    """
    for other, caches in _caches.items():
        if other != name:
            for kept in caches.values():
                kept.clear()
    return _caches.setdefault(name, {}).setdefault(owner, {})


def map_texts(df: DataFrame, schema, start: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]],
              most_rows: int = BATCH_ROWS, cache: str = "") -> DataFrame:
    """Run a batch function over ``df`` on the executors, in Arrow batches of bounded size.

    ``start()`` runs once in each task and returns the batch function, so that vocabularies and
    models are loaded there. No shuffle; a lost task is simply run again. ``cache`` names the
    worker cache that the function uses, if any.
    """
    def run(batches):
        worker_cache(cache)
        handle = start()
        for batch in batches:
            yield from map(handle, small_batches(batch, most_rows))
        # the executor's limit counts what a worker holds on to for its next task
        pa.default_memory_pool().release_unused()

    ship_package(df.sparkSession)
    return df.mapInArrow(run, schema)


def as_bytes(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8 bytes; null is empty."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


def as_texts(column: pa.Array) -> list[str]:
    """Texts; null is empty."""
    return [value or "" for value in column.to_pylist()]
