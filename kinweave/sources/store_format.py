"""An outside document store as a data source of Spark: a folder of JSON lines, written and read in shards.

``spark.read.format("document_store")`` reads a partition a file, and only the shards that a condition on the document id
leaves; ``df.write.format("document_store")`` writes a file a task and shard. Files count once a commit lists them, so what a
failed or repeated task left behind is never read, and a job that breaks off has changed nothing.

| path below the folder | |
| --- | --- |
| ``data/<shard>/<name>.jsonl`` | documents whose id falls into the shard: ``{"_id": ..., field: ...}`` |
| ``commits/<name>.json`` | the files that one job added, and whether it replaced all before |

The folder is any that pyarrow reaches from every machine: mounted, or of an object store. A document has the id as
``_metadata._id``, as connectors of search indexes show it, and string fields. Repeated ids are documents of their own.
"""

import hashlib
import json
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession, types as T
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, WriterCommitMessage,
)

from kinweave import session

NAME = "document_store"
SHARDS = 16
BATCH_ROWS = 4096
ID = ("_metadata", "_id")
SCHEMA = "_metadata struct<_id: string>, vertexId string"


def register(spark: SparkSession) -> None:
    """Make the format known to a session and its executors, and to the active session, where Spark looks formats up."""
    session.ship_package(spark)
    for each in {id(found): found for found in (spark, SparkSession.getActiveSession() or spark)}.values():
        each.dataSource.register(DocumentStore)


def shard_of(document_id: str, shards: int) -> int:
    return int.from_bytes(hashlib.blake2b(document_id.encode(), digest_size=8).digest(), "little") % shards


def open_folder(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:") or "://" not in path:
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


class Folder:
    """The committed files of a store."""

    def __init__(self, path: str):
        self.system, self.root = open_folder(path.rstrip("/"))

    def commits(self) -> list[dict]:
        listed = self.system.get_file_info(fs.FileSelector(f"{self.root}/commits", allow_not_found=True))
        found = []
        for info in listed:
            if info.base_name.endswith(".json"):
                with self.system.open_input_stream(info.path) as source:
                    found.append(json.loads(source.read()))
        return sorted(found, key=lambda commit: commit["number"])

    def files(self) -> list[dict]:
        """name and shard of every file that counts: those since the last commit that replaced all."""
        kept = []
        for commit in self.commits():
            kept = commit["files"] if commit["replaces"] else kept + commit["files"]
        return kept

    def shards(self, default: int) -> int:
        commits = self.commits()
        return commits[-1]["shards"] if commits else default

    def write(self, name: str, data: bytes) -> None:
        self.system.create_dir(name.rsplit("/", 1)[0], recursive=True)
        with self.system.open_output_stream(name) as target:
            target.write(data)


class DocumentStore(DataSource):
    """Options: ``path``; ``shards`` of a store that is new."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: T.StructType) -> "DocumentReader":
        return DocumentReader(self.options["path"], schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> "DocumentWriter":
        return DocumentWriter(self.options["path"], schema, int(self.options.get("shards", SHARDS)), overwrite)


@dataclass
class File(InputPartition):
    name: str


class DocumentReader(DataSourceReader):
    def __init__(self, path: str, schema: T.StructType):
        self.path, self.schema = path, schema
        self.fields = [f.name for f in schema.fields if f.name != ID[0]]
        self.ids: set[str] | None = None  # the ids that conditions leave

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes conditions that list ids; the others stay with Spark."""
        for condition in filters:
            if isinstance(condition, EqualTo) and condition.attribute == ID:
                wanted = {condition.value}
            elif isinstance(condition, In) and condition.attribute == ID:
                wanted = set(condition.value)
            else:
                yield condition
                continue
            self.ids = wanted if self.ids is None else self.ids & wanted

    def partitions(self) -> Sequence[File]:
        folder = Folder(self.path)
        files = folder.files()
        if self.ids is not None:
            shards = folder.shards(SHARDS)
            wanted = {shard_of(i, shards) for i in self.ids if i is not None}
            files = [file for file in files if file["shard"] in wanted]
        # Spark asks for at least one partition; an empty name has no rows
        return [File(file["name"]) for file in files] or [File("")]

    def read(self, partition: File) -> Iterator[pa.RecordBatch]:
        if not partition.name:
            return
        system, root = open_folder(self.path.rstrip("/"))
        types = pa.schema([pa.field(ID[0], pa.struct([(ID[1], pa.string())])), *[(name, pa.string()) for name in self.fields]])
        order = [f.name for f in self.schema.fields]
        rows = []
        with system.open_input_stream(f"{root}/{partition.name}") as source:
            for line in _lines(source):
                document = json.loads(line)
                if self.ids is None or document["_id"] in self.ids:
                    rows.append({ID[0]: {ID[1]: document["_id"]}, **{name: document.get(name) for name in self.fields}})
                if len(rows) == BATCH_ROWS:
                    yield pa.RecordBatch.from_pylist(rows, types).select(order)
                    rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, types).select(order)


def _lines(source: pa.NativeFile) -> Iterator[bytes]:
    rest = b""
    while block := source.read(1 << 20):
        *whole, rest = (rest + block).split(b"\n")
        yield from whole
    if rest:
        yield rest


@dataclass
class Written(WriterCommitMessage):
    files: list[dict]


class DocumentWriter(DataSourceArrowWriter):
    def __init__(self, path: str, schema: T.StructType, shards: int, overwrite: bool):
        self.path, self.overwrite = path, overwrite
        # a store keeps its number of shards until it is replaced
        self.shards = shards if overwrite else Folder(path).shards(shards)
        self.fields = [f.name for f in schema.fields if f.name != ID[0]]
        if ID[0] not in schema.fieldNames():
            raise ValueError(f"a document needs its id as {'.'.join(ID)}")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        """One file a shard, of a name of its own: nobody reads it before the commit lists it."""
        folder, files = Folder(self.path), {}
        try:
            for batch in iterator:
                for row in batch.to_pylist():
                    document = {"_id": row[ID[0]][ID[1]], **{name: row[name] for name in self.fields if row[name] is not None}}
                    shard = shard_of(document["_id"], self.shards)
                    if shard not in files:
                        name = f"data/{shard}/{uuid.uuid4().hex}.jsonl"
                        folder.system.create_dir(f"{folder.root}/data/{shard}", recursive=True)
                        files[shard] = name, folder.system.open_output_stream(f"{folder.root}/{name}")
                    files[shard][1].write(json.dumps(document, ensure_ascii=False).encode() + b"\n")
        except BaseException:
            for name, target in files.values():
                target.close()
                folder.system.delete_file(f"{folder.root}/{name}")
            raise
        for _, target in files.values():
            target.close()
        return Written([{"name": name, "shard": shard} for shard, (name, _) in files.items()])

    def commit(self, messages: list[Written | None]) -> None:
        """One commit lists the files of all tasks; it becomes visible by its name."""
        folder = Folder(self.path)
        commits = folder.commits()
        number = commits[-1]["number"] + 1 if commits else 0
        files = [file for message in messages if message for file in message.files]
        text = json.dumps({"number": number, "replaces": self.overwrite, "shards": self.shards, "files": files}).encode()
        name = f"{folder.root}/commits/{number:012d}"
        folder.write(f"{name}.writing", text)
        folder.system.move(f"{name}.writing", f"{name}.json")

    def abort(self, messages: list[Written | None]) -> None:
        """Files of tasks that had ended are deleted; none was ever listed."""
        folder = Folder(self.path)
        for message in messages:
            for file in message.files if message else ():
                folder.system.delete_file(f"{folder.root}/{file['name']}")
