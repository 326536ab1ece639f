"""Tables stored in parts: a base and what came later, merged when read.

A table's rows have a key and values that combine by maximum or sum, so a change is a row to be combined with those
already there, and a job writes what changed and nothing else. A snapshot lists the parts of each table.

* A *base* holds one row a key, in folders by bucket, a hash of the table's clustering column; sorted by key within a bucket.
  A part may be listed for some of its buckets only: the others have been rewritten in a later base.
* *Deltas* are small flat files with the bucket as a column. FANOUT deltas of one level merge into one of the next; when the
  deltas hold more than 1 / FANOUT of the base's rows they are merged into it, bucket by bucket where there are any. So
  a row is rewritten a number of times that grows with the logarithm of the table.

A hub's rows lie in one bucket, but ranges over the whole key split them over tasks and files.
"""

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

BASE = -1
FANOUT = 4
BUCKET = "bucket"


@dataclass(frozen=True)
class Kind:
    """A table's columns: its key, how its values combine, what it is clustered by, and which rows a base need not keep."""

    schema: T.StructType
    key: tuple[str, ...]
    combine: dict[str, str] = field(default_factory=dict)  # value column -> "max" or "sum"
    clustered_by: str = ""
    empty: Callable[[], Column] | None = None
    lookups: bool = False  # bloom filters for point lookups by the clustering column

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def stored(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType())])


@dataclass(frozen=True)
class Part:
    table: str
    path: str
    level: int
    n_rows: int
    buckets: tuple[int, ...] | None = None  # the buckets it is listed for; None: all it has


def bucket_of(column: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(buckets)).cast("int").alias(BUCKET)


def with_bucket(df: DataFrame, kind: Kind, buckets: int) -> DataFrame:
    return df.select(*kind.columns, bucket_of(F.col(kind.clustered_by), buckets))


def read_part(spark: SparkSession, part: Part, kind: Kind, only: list[int] | None = None) -> DataFrame:
    """The part's rows with their bucket, of the buckets it is listed for and of ``only``."""
    rows = spark.read.schema(kind.stored).parquet(part.path)
    wanted = None if part.buckets is None else set(part.buckets)
    if only is not None:
        wanted = set(only) if wanted is None else wanted & set(only)
    return rows if wanted is None else rows.where(F.col(BUCKET).isin(sorted(wanted)))


def combine(df: DataFrame, kind: Kind) -> DataFrame:
    """One row a key."""
    how = {"max": F.max, "sum": F.sum}
    values = [how[way](name).alias(name) for name, way in kind.combine.items()]
    key = [*kind.key, BUCKET]
    return df.groupBy(*key).agg(*values) if values else df.select(*key).distinct()


def read(spark: SparkSession, parts: list[Part], kind: Kind, only: list[int] | None = None) -> DataFrame:
    """The table with its bucket: base rows nothing came later for pass through, the others are combined.

    The deltas are looked up in the base by key. A short delta is broadcast by its size, so no row of
    the base is shuffled then.
    """
    base = union([read_part(spark, part, kind, only) for part in parts if part.level == BASE])
    later = union([read_part(spark, part, kind, only) for part in parts if part.level != BASE])
    if base is None and later is None:
        return spark.createDataFrame(pa.Table.from_pylist([], to_arrow_schema(kind.stored)), kind.stored)
    if later is None:
        return base
    if base is None or not kind.combine:
        return combine(later, kind) if base is None else base.unionByName(later)
    touched = later.select(*kind.key).distinct()
    same = base.join(touched, list(kind.key), "left_anti")
    changed = combine(base.join(touched, list(kind.key), "left_semi").unionByName(later), kind)
    return same.unionByName(changed)


def union(tables: list[DataFrame]) -> DataFrame | None:
    found = None
    for table in tables:
        found = table if found is None else found.unionByName(table)
    return found


def write_delta(df: DataFrame, table: str, kind: Kind, buckets: int, path: str) -> list[Part]:
    """Write a change as a flat part of level 0; nothing is listed if it has no rows."""
    return _flat(with_bucket(df, kind, buckets), table, 0, path)


def _flat(rows: DataFrame, table: str, level: int, path: str) -> list[Part]:
    rows.write.parquet(path)
    n = rows.sparkSession.read.parquet(path).count()
    return [Part(table, path, level, n)] if n else []


def write_base(df: DataFrame, table: str, kind: Kind, buckets: int, path: str) -> list[Part]:
    """Write rows of one a key as a base. Rows that say nothing are left out."""
    rows = df if kind.empty is None else df.where(~kind.empty())
    rows = with_bucket(rows, kind, buckets)
    order = list(dict.fromkeys((BUCKET, kind.clustered_by, *kind.key)))  # the whole key, so that a hub is split
    clustered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    writer = clustered.write.partitionBy(BUCKET)
    if kind.lookups:
        writer = writer.option(f"parquet.bloom.filter.enabled#{kind.clustered_by}", "true")
    writer.parquet(path)
    n = rows.sparkSession.read.schema(kind.stored).parquet(path).count()
    return [Part(table, path, BASE, n)] if n else []


def side_by_side(steps: Iterable[Callable[[], list[Part]]]) -> list[Part]:
    """The parts that independent writes give. Small ones take longer to start than to run, so they run at the same time."""
    steps = list(steps)
    with ThreadPoolExecutor(max(1, len(steps))) as pool:
        return [part for found in pool.map(lambda step: step(), steps) for part in found]


def settle(spark: SparkSession, parts: list[Part], table: str, kind: Kind, buckets: int, folder: str) -> list[Part]:
    """Merge the deltas of one table where a level is full, and into the base where they have become a large part of it."""
    number = 0
    while True:
        levels: dict[int, list[Part]] = {}
        for part in parts:
            levels.setdefault(part.level, []).append(part)
        base_rows = sum(part.n_rows for part in levels.get(BASE, []))
        later = [part for part in parts if part.level != BASE]
        if later and sum(part.n_rows for part in later) * FANOUT > base_rows:
            return _into_base(spark, parts, table, kind, buckets, f"{folder}/{table}")
        full = min((level for level, found in levels.items() if level != BASE and len(found) >= FANOUT), default=None)
        if full is None:
            return parts
        number += 1
        merged = combine(union([read_part(spark, part, kind) for part in levels[full]]), kind)
        written = _flat(merged.select(*kind.columns, BUCKET), table, full + 1, f"{folder}/{table}-merged-{number}")
        parts = [part for part in parts if part.level != full] + written


def _into_base(spark, parts, table, kind, buckets, path) -> list[Part]:
    """Rewrite the buckets that the deltas touch; base parts stay listed for the others."""
    later = union([read_part(spark, part, kind) for part in parts if part.level != BASE])
    touched = sorted(row[0] for row in later.select(BUCKET).distinct().collect())  # at most one number a bucket
    # the deltas are a large part of the base here, so one grouping of both is less than look-ups
    rows = read(spark, parts, kind, touched)
    if kind.combine:
        rows = combine(union([read_part(spark, part, kind, touched) for part in parts]), kind)
    new = write_base(rows, table, kind, buckets, path)
    kept = []
    for part in parts:
        if part.level == BASE:
            left = tuple(b for b in (part.buckets if part.buckets is not None else range(buckets)) if b not in set(touched))
            if left:
                kept.append(replace(part, buckets=left))
    return kept + [replace(part, buckets=tuple(touched)) for part in new]


def collapse(spark: SparkSession, parts: list[Part], table: str, kind: Kind, buckets: int, path: str) -> list[Part]:
    """The table as a base of one row a key, where its base may hold repeated ones."""
    rows = union([read_part(spark, part, kind) for part in parts])
    return parts if rows is None else write_base(combine(rows, kind), table, kind, buckets, path)
