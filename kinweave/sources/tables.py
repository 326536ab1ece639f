"""Tables in the shared folder, and temp views over them."""

from pyspark.sql import DataFrame, SparkSession, types as T


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to a new path and return a scan of it.

    The written files cut the lineage: a lost executor costs only the tasks it ran, and
    every later reader gets the same rows, column pruning and real file sizes.
    """
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(_nullable(df.schema)).parquet(path)


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema])


def register_views(**views: DataFrame) -> None:
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def cache_view(spark: SparkSession, name: str) -> None:
    """Fill the cache of a temp view now. A cache saves time; it is no snapshot."""
    spark.sql(f"CACHE TABLE `{name}`")


def drop_views(spark: SparkSession, *names: str) -> None:
    for name in names:
        spark.catalog.dropTempView(name)
