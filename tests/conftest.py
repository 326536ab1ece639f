import pyarrow as pa
import pytest
from pyspark.sql.pandas.types import to_arrow_schema

from kinweave.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "kinweave-tests", master="local[4]",
        **{
            "spark.sql.shuffle.partitions": "2",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.session.timeZone": "UTC",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make(spark):
    """A small DataFrame from a schema and rows; through Arrow, which needs no Python worker."""
    def table(schema, *rows):
        records = [dict(zip(schema.fieldNames(), row)) for row in rows]
        return spark.createDataFrame(pa.Table.from_pylist(records, to_arrow_schema(schema)), schema)
    return table
