import uuid
from types import SimpleNamespace

import duckdb
import pytest

from kinweave import schemas, session
from kinweave.plans import store
from kinweave.sources import index, roster, tables
from kinweave.sources.outside import write_partitions


class JdbcReader:
    """Stands in for ``spark.read``: answers the probe, records the calls."""

    def __init__(self, spark, top):
        self.spark, self.top, self.calls = spark, top, []

    def jdbc(self, url, table, **options):
        self.calls.append((url, table, options))
        if len(self.calls) == 1:
            return self.spark.createDataFrame([(self.top,)], "top_id long")
        return self.spark.createDataFrame([(1, "a", "b", "u")], schemas.RELATION)


def test_jdbc_scan_is_filtered_in_the_database_and_partitioned(spark):
    reader = JdbcReader(spark, 1500)
    df = roster.read_relation_jdbc(SimpleNamespace(read=reader), "jdbc:x", "roster_view", {"user": "me"}, 4)
    (_, probe, _), (_, table, options) = reader.calls
    assert "WHERE" not in probe and "MAX(rosterID)" in probe
    for part in ("sub = 3", "userID IS NOT NULL", "username <> loginAccount", "FROM roster_view"):
        assert part in table
    assert options == {"column": "rosterId", "lowerBound": 1, "upperBound": 1500, "numPartitions": 4,
                       "properties": {"user": "me"}}
    assert df.schema.fieldNames() == schemas.RELATION.fieldNames()


def test_jdbc_scan_of_an_empty_view(spark):
    reader = JdbcReader(spark, None)
    roster.read_relation_jdbc(SimpleNamespace(read=reader), "jdbc:x", "v", {}, 4, quote='"')
    _, table, options = reader.calls[1]
    assert '"userID" IS NOT NULL' in table
    assert options == {"properties": {}}


class SqlReader:
    """Stands in for a database: answers queries on a roster of its own, by DuckDB, and keeps what was asked."""

    def __init__(self, spark, keys):
        self.spark, self.asked = spark, []
        self.store = duckdb.connect()
        self.store.execute("CREATE TABLE roster_view (rosterID BIGINT, username TEXT, loginAccount TEXT, userID TEXT, sub INT)")
        for n, key in enumerate(keys):
            self.store.execute("INSERT INTO roster_view VALUES (?, 'a', 'b', 'u', ?)", [key, 3 if n % 5 else 1])

    def jdbc(self, url, table, predicates=None, properties=None):
        self.asked.append(table)
        found = [self.store.execute(f"SELECT * FROM {table}" + (f" WHERE {where}" if where else "")) for where in predicates or [""]]
        self.parts = [self.store.execute(f"SELECT * FROM {table} WHERE {where}").fetchall() for where in predicates or []]
        names = [column[0] for column in found[-1].description]
        rows = [row for part in self.parts for row in part] if predicates else found[0].fetchall()
        kinds = ["string" if name in ("username", "loginAccount", "userId") else "double" if name == "cell_no" else "long" for name in names]
        return self.spark.createDataFrame(rows, ", ".join(f"{name} {kind}" for name, kind in zip(names, kinds)))


@pytest.mark.parametrize("keys", [
    list(range(1, 400)), [10 ** 12 + n for n in range(200)] + list(range(5)) + [7 * 10 ** 8], [1] * 3 + [2 ** 40 - n * n for n in range(300)],
    [5], [], [None] * 7 + list(range(0, 90, 3)), [-50, -49, 10 ** 9] + list(range(-9, 30)),
])
def test_ranges_of_a_key_with_gaps_hold_every_row_once_and_no_more_than_their_share(spark, keys):
    reader = SqlReader(spark, keys)
    session_like = SimpleNamespace(read=reader)
    found = roster.read_relation_jdbc_balanced(session_like, "jdbc:x", "roster_view", {}, 8, cells=16)
    kept = [key for n, key in enumerate(keys) if n % 5]
    assert sorted((row.rosterId for row in found.collect()), key=str) == sorted(kept, key=str)
    assert found.schema.fieldNames() == schemas.RELATION.fieldNames()
    with_key = [key for key in kept if key is not None]
    share = -(-len(with_key) // 8)
    for part in reader.parts:
        counted = [row[0] for row in part if row[0] is not None]
        assert len(counted) <= share or len(set(counted)) == 1
    assert len(reader.parts) <= 16 and len(reader.asked) < 60


def test_roster_files(spark, tmp_path):
    spark.createDataFrame([(1, "a", "b", "u", 3)], schemas.ROSTER).write.parquet(str(tmp_path / "r"))
    assert [tuple(r) for r in roster.read_roster_files(spark, str(tmp_path / "r")).collect()] == [(1, "a", "b", "u", 3)]


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_id_map_documents_round_trip(spark, tmp_path, fmt):
    id_map = spark.createDataFrame([("u1", "v1"), ("u2", "v2")], schemas.ID_MAP)
    path = str(tmp_path / "docs")
    index.write_id_map_documents(id_map, fmt, path)
    assert sorted(map(tuple, index.read_id_map_documents(spark, fmt, path).collect())) == [("u1", "v1"), ("u2", "v2")]


def test_stores_start_empty_and_typed(spark, tmp_path):
    graph = store.create(spark, str(tmp_path / "g"))
    for name, schema in store.TABLES.items():
        table = getattr(graph, name)
        assert table.isEmpty() and table.schema.fieldNames() == schema.fieldNames()


def test_written_table_is_never_overwritten(spark, tmp_path):
    df = spark.range(3)
    assert tables.write_table(df, str(tmp_path / "t")).count() == 3
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        tables.write_table(df, str(tmp_path / "t"))


def test_views(spark):
    tables.register_views(some_numbers=spark.range(5), more_numbers=spark.range(6))
    tables.cache_view(spark, "some_numbers")
    assert spark.catalog.isCached("some_numbers")
    assert spark.sql("SELECT count(*) FROM some_numbers").first()[0] == 5
    tables.drop_views(spark, "some_numbers", "more_numbers", "never_there")
    assert not spark.catalog.tableExists("some_numbers")


def test_outside_sink_has_one_client_per_partition(spark, tmp_path):
    folder = str(tmp_path)

    def open_client():
        return open(f"{folder}/{uuid.uuid4().hex}", "w")

    def write_rows(client, batch):
        assert len(batch) <= 3
        client.write("".join(f"{row.id}\n" for row in batch))

    write_partitions(spark.range(10).repartition(2), open_client, write_rows, batch_rows=3)
    files = list(tmp_path.iterdir())
    assert len(files) == 2
    assert sorted(int(line) for f in files for line in f.read_text().split()) == list(range(10))


def test_shared_folder_is_the_configured_one(spark):
    assert session.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert session.new_folder(spark, "x") != session.new_folder(spark, "x")


def unconfigured(master):
    context = SimpleNamespace(master=master, applicationId="app", getCheckpointDir=lambda: None)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default), sparkContext=context)


def test_a_folder_must_be_named():
    for master in ("spark://host:7077", "local[2]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            session.shared_folder(unconfigured(master))


SIZE = session.BYTES_PER_PARTITION


@pytest.mark.parametrize("sizes, each, partitions", [([10 * SIZE], SIZE, "10"), ([6 * SIZE, 1], SIZE, "7"),
                                                     ([10 ** 14], SIZE, "1490117"), ([10 ** 14], 100 * SIZE, "14902"), ([1000], SIZE, None)])
def test_shuffles_are_sized_by_the_input_in_a_session_of_their_own(spark, monkeypatch, sizes, each, partitions):
    left = iter(sizes)
    monkeypatch.setattr(session, "planned_bytes", lambda df: next(left))
    before = dict(spark.conf.getAll)
    other = session.tuned(spark, *[spark.range(1)] * len(sizes), bytes_per_partition=each)
    assert other.conf.get(session.INITIAL_PARTITIONS, None) == partitions
    assert dict(spark.conf.getAll) == before


def test_settings_are_taken_over_and_a_larger_number_of_partitions_stays(spark, monkeypatch):
    caller = spark.newSession()
    caller.conf.set(session.INITIAL_PARTITIONS, "500")
    caller.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    monkeypatch.setattr(session, "planned_bytes", lambda df: 10 * SIZE)
    other = session.tuned(caller, spark.range(1))
    assert other.conf.get(session.INITIAL_PARTITIONS) == "500"
    assert other.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"


def test_an_input_of_unknown_size_is_refused(spark, monkeypatch):
    monkeypatch.setattr(session, "planned_bytes", lambda df: 2 ** 62)
    with pytest.raises(ValueError, match="write it"):
        session.tuned(spark, spark.range(1))
