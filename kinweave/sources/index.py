"""The id map as documents of a search index: document id = user, field = vertex."""

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_id_map_documents(spark: SparkSession, fmt: str, resource: str, **options: str) -> DataFrame:
    """Scan the index through any connector that shows document metadata as a column."""
    return id_map_from_documents(spark.read.format(fmt).options(**options).load(resource))


def id_map_from_documents(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("_metadata._id").alias("user_id"), F.col("vertexId").alias("vertex_id"))


def documents_from_id_map(id_map: DataFrame) -> DataFrame:
    return id_map.select(
        F.struct(F.col("user_id").alias("_id")).alias("_metadata"),
        F.col("vertex_id").alias("vertexId"),
    )


def write_id_map_documents(id_map: DataFrame, fmt: str, resource: str, mode: str = "append", **options: str) -> None:
    documents_from_id_map(id_map).write.format(fmt).options(**options).mode(mode).save(resource)
