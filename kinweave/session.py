"""Session settings and the shared folder that jobs write their tables to."""

import math
import tempfile
import uuid
import zipfile
from pathlib import Path
from weakref import WeakSet

from pyspark.sql import DataFrame, SparkSession

# Run-time settings the joins rely on: a join key that holds a large share of the
# rows is split over many tasks, also when that costs one more shuffle later on. The
# threshold is low because rows of one key compress well and look small.
# Small shuffles keep all cores busy, as a join can multiply their rows.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # ids are most of what is written
    "spark.sql.parquet.compression.codec": "zstd",
    # keyed state of a stream that outgrows memory, and what transformWithState asks for
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # state with an expiry would else run batches without data for ever where a stream is to end
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
    # conditions on document ids reach a store read by Python
    "spark.sql.python.filterPushdown.enabled": "true",
}
BYTES_PER_PARTITION = 64 * 1024 * 1024
UNKNOWN_BYTES = 2 ** 60
_shipped: WeakSet = WeakSet()  # the contexts that have this package on their executors
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def build_session(app_name: str = "kinweave", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**ADAPTIVE, "spark.ui.enabled": "false", **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tuned(spark: SparkSession, *inputs: DataFrame, bytes_per_partition: int = BYTES_PER_PARTITION) -> SparkSession:
    """A session for jobs over ``inputs``: the caller's settings, skew handling, shuffles sized for the inputs.

    The caller's session stays as it is; what is read through the new one runs under the new
    settings. Shuffles start with one partition per ``bytes_per_partition`` of input, and AQE
    merges what turns out small. Choose it for the cluster: the memory of a task bounds it from
    above, the number of shuffle blocks the driver keeps track of from below. A larger
    number of partitions that is already set stays.
    """
    sizes = [planned_bytes(df) for df in inputs]
    if any(size >= UNKNOWN_BYTES for size in sizes):
        raise ValueError("the size of an input is unknown; write it to a table first")
    other = spark.newSession()
    for key, value in {**spark.conf.getAll, **ADAPTIVE}.items():
        if spark.conf.isModifiable(key):
            other.conf.set(key, value)
    wanted = math.ceil(sum(sizes) / bytes_per_partition)
    current = other.conf.get(INITIAL_PARTITIONS, None) or other.conf.get("spark.sql.shuffle.partitions")
    if wanted > int(current):
        other.conf.set(INITIAL_PARTITIONS, str(wanted))
    return other


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package: once a Spark context it is sent to the executors as an archive.

    Only streams with keyed state and the document store run Python on executors.
    """
    context = spark.sparkContext
    if context in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix=f"{package.name}-")) / f"{package.name}-graph.zip"
    with zipfile.ZipFile(archive, "w") as target:
        for source in sorted(package.rglob("*.py")):
            target.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context)


def planned_bytes(df: DataFrame) -> int:
    """Size of ``df`` as the optimizer estimates it (file sizes for a plain scan)."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``; it must be set.

    A ``file:`` path is fine where all machines mount it; nothing can tell that from here.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        raise ValueError("set spark.checkpoint.dir to a folder shared by driver and executors")
    return named.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; no two runs ever share one."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
