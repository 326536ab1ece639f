"""The document store: round trips, pruned reads, commits and aborts."""

from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, In, IsNotNull
from pyspark.sql.types import _parse_datatype_string

from kinweave import schemas
from kinweave.sources import index, store_format
from kinweave.sources.store_format import DocumentReader, DocumentWriter, Folder, shard_of


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def registered(spark):
    store_format.register(spark)
    return spark


def id_map(make, *users):
    return make(schemas.ID_MAP, *[(user, f"v-{user}") for user in users])


def test_jobs_add_up_and_overwriting_replaces_all(registered, make, tmp_path):
    path = str(tmp_path / "store")
    users = [f"u{n}" for n in range(200)] + ["é\n\"x", "", "u0"]
    index.write_id_map_documents(id_map(make, *users[:90]).repartition(3), store_format.NAME, path)
    index.write_id_map_documents(id_map(make, *users[90:]), store_format.NAME, f"file:{path}", shards="5")
    found = index.read_id_map_documents(registered, store_format.NAME, path)
    assert rows(found) == sorted(((user, f"v-{user}") for user in users), key=str)
    assert len(Folder(path).commits()) == 2 and Folder(path).shards(0) == store_format.SHARDS
    index.write_id_map_documents(id_map(make, "only"), store_format.NAME, path, mode="overwrite", shards="3")
    assert rows(index.read_id_map_documents(registered, store_format.NAME, path)) == [("only", "v-only")]
    assert Folder(path).shards(0) == 3


def test_a_store_that_is_not_there_and_one_without_documents_are_empty(registered, make, tmp_path):
    assert rows(index.read_id_map_documents(registered, store_format.NAME, str(tmp_path / "nothing"))) == []
    index.write_id_map_documents(id_map(make), store_format.NAME, str(tmp_path / "empty"))
    assert rows(index.read_id_map_documents(registered, store_format.NAME, str(tmp_path / "empty"))) == []


def test_conditions_on_the_id_leave_few_shards(registered, make, tmp_path):
    path = str(tmp_path / "store")
    users = [f"u{n}" for n in range(300)]
    index.write_id_map_documents(id_map(make, *users), store_format.NAME, path)
    read = index.read_id_map_documents(registered, store_format.NAME, path)
    assert rows(read.where("user_id = 'u7'")) == [("u7", "v-u7")]
    assert rows(read.where(F.col("user_id").isin("u7", "u9", "nobody"))) == [("u7", "v-u7"), ("u9", "v-u9")]
    assert rows(read.where("user_id = 'u7' AND vertex_id = 'x'")) == []
    schema = _parse_datatype_string(store_format.SCHEMA)
    reader = DocumentReader(path, schema)
    left = [IsNotNull(("vertexId",)), EqualTo(("vertexId",), "v-u7")]
    assert list(reader.pushFilters([left[0], In(store_format.ID, ("u7", "u9")), left[1], EqualTo(store_format.ID, "u9")])) == left
    files = reader.partitions()
    assert {file.name.split("/")[1] for file in files} == {str(shard_of("u9", store_format.SHARDS))}
    assert len(DocumentReader(path, schema).partitions()) > 4 * len(files)
    found = [row for file in files for batch in reader.read(file) for row in batch.to_pylist()]
    assert found == [{"_metadata": {"_id": "u9"}, "vertexId": "v-u9"}]


def test_a_job_that_fails_leaves_nothing_visible(registered, make, tmp_path):
    path = str(tmp_path / "store")
    index.write_id_map_documents(id_map(make, "there"), store_format.NAME, path)
    broken = registered.range(40).repartition(4).select(
        F.struct(F.concat(F.lit("u"), "id").alias("_id")).alias("_metadata"),
        F.when(F.col("id") == 33, F.raise_error(F.lit("lost"))).otherwise(F.lit("v")).alias("vertexId"))
    with pytest.raises(Exception, match="lost"):
        broken.write.format(store_format.NAME).mode("append").save(path)
    assert rows(index.read_id_map_documents(registered, store_format.NAME, path)) == [("there", "v-there")]
    assert len(Folder(path).files()) == 1 and not list(Path(path).rglob("*.writing"))


def test_files_of_an_aborted_task_are_never_read(tmp_path):
    path, schema = str(tmp_path / "store"), _parse_datatype_string(store_format.SCHEMA)
    writer = DocumentWriter(path, schema, 4, False)
    batch = pa.RecordBatch.from_pylist([{"_metadata": {"_id": f"u{n}"}, "vertexId": None if n == 1 else "v"} for n in range(9)])
    first, second = writer.write(iter([batch])), writer.write(iter([batch]))  # a task that ran twice
    assert Folder(path).files() == []
    writer.commit([first, None])
    reader = DocumentReader(path, schema)
    found = [row for file in reader.partitions() for part in reader.read(file) for row in part.to_pylist()]
    assert len(found) == 9 and {row["vertexId"] for row in found} == {None, "v"}
    writer.abort([second, None])
    assert {str(file.relative_to(path)) for file in Path(path).rglob("*.jsonl")} == {file["name"] for file in first.files}

    def failing():
        yield batch
        raise RuntimeError("lost")

    before = len(list(Path(path).rglob("*.jsonl")))
    with pytest.raises(RuntimeError):
        writer.write(failing())
    assert len(list(Path(path).rglob("*.jsonl"))) == before


def test_documents_need_an_id(tmp_path):
    with pytest.raises(ValueError, match="_metadata._id"):
        DocumentWriter(str(tmp_path), _parse_datatype_string("vertexId string"), 4, False)
