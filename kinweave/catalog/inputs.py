"""The graph's inputs, derived from the given order, customer, supplier and event tables.

Every derivation reads whole tables; its size grows with them. Roster rows come from
orders (owner = ordering customer), with planted NULL users, self rows, alias accounts,
unresolvable owners, self edges and unconfirmed rows.
"""

from functools import cached_property
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from kinweave import session
from kinweave.operators import idmap, neighbourhood, roster
from kinweave.plans import jobs, store
from kinweave.sources.index import read_id_map_documents, write_id_map_documents
from kinweave.sources.tables import write_table

HOT_THRESHOLD = 12

_by_session: WeakKeyDictionary = WeakKeyDictionary()


def inputs(spark: SparkSession, sf_dir: str) -> "Inputs":
    """The inputs of a data directory; what was written once is shared by all queries of a session."""
    of_session = _by_session.setdefault(spark, {})
    if sf_dir not in of_session:
        of_session[sf_dir] = Inputs(spark, sf_dir)
    return of_session[sf_dir]


def _name(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), number.cast("string"))


class Inputs:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.sf_dir = sf_dir
        self.spark = spark
        sized = [self.table(name) for name in ("orders", "customer", "supplier", "events", "lineitem")]
        self.spark = session.tuned(spark, *sized)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def _written(self, name: str, df: DataFrame) -> DataFrame:
        return write_table(df, session.new_folder(self.spark, name))

    @cached_property
    def rosters(self) -> DataFrame:
        """Roster rows with their state now (``sub``) and at the last sync (``earlier_sub``)."""
        n = self.table("customer").agg(F.count("*")).scalar()
        key, owner = F.col("o_orderkey"), F.col("o_custkey")
        listed = (
            F.when(key % 101 == 0, owner)
            .when((key % 7 == 0) & (owner % 40 == 0), owner + 1)
            .when((key % 3 == 0) & (owner % 150 == 0), owner + 2)
            .when((key % 2 == 0) & (owner % 150 == 2), owner - 2)
            .otherwise((owner * 31 + key * 17 + 7) % F.col("n"))
        )
        friend = F.when(F.col("f0") % 23 == 5, F.col("f0") - 1).otherwise(F.col("f0"))
        f = F.col("f")
        user = (
            F.when(key % 97 == 0, F.lit(None).cast("string"))
            .when(key % 107 == 0, _name("u", (f + 3) % F.col("n")))
            .otherwise(_name("u", F.when(f % 40 == 1, f - 1).otherwise(f)))
        )
        rows = self.table("orders").withColumn("n", n).withColumn("f0", listed).withColumn("f", friend).select(
            (key + 1).alias("rosterID"), _name("acct", owner).alias("username"),
            _name("acct", f).alias("loginAccount"), user.alias("userID"),
            F.when(key % 5 == 0, 1).otherwise(3).alias("sub"),
            F.when(F.col("o_orderstatus") == "P", 1).otherwise(3).alias("earlier_sub"),
        )
        return self._written("rosters", rows)

    @property
    def roster(self) -> DataFrame:
        return self.rosters.drop("earlier_sub")

    @property
    def earlier_roster(self) -> DataFrame:
        return self.rosters.drop("sub").withColumnRenamed("earlier_sub", "sub")

    @property
    def relation(self) -> DataFrame:
        return roster.relation(self.roster)

    @cached_property
    def friendships(self) -> DataFrame:
        return self._written("friendships", roster.friendships(self.relation))

    @cached_property
    def users(self) -> DataFrame:
        return self._written("users", roster.users(self.relation))

    @property
    def id_map(self) -> DataFrame:
        return idmap.with_vertex_ids(self.users)

    @cached_property
    def id_map_documents(self) -> DataFrame:
        """The id map as read back from the documents of an index."""
        path = session.new_folder(self.spark, "documents")
        write_id_map_documents(self.id_map, "parquet", path)
        return read_id_map_documents(self.spark, "parquet", path)

    @cached_property
    def people(self) -> DataFrame:
        return self._written("people", neighbourhood.people(self.friendships, self.id_map))

    @cached_property
    def requests(self) -> DataFrame:
        """What users ask about: their friends, a friend of each friend, strangers, themselves."""
        friends = self.friendships.select("user_id", F.col("friend_user_id").alias("candidate_id"))
        suggested = self._written("suggested", friends.groupBy(F.col("user_id").alias("friend_user_id")).agg(
            F.max("candidate_id").alias("candidate_id")
        ))
        friend_of_friend = self.friendships.join(suggested, "friend_user_id").select("user_id", "candidate_id")
        n = self.table("customer").agg(F.count("*")).scalar()
        key, owner = F.col("o_orderkey"), F.col("o_custkey")
        strangers = self.table("orders").withColumn("n", n).select(
            _name("u", owner).alias("user_id"),
            _name("u", (owner * 13 + key * 29 + 3) % F.col("n")).alias("candidate_id"),
        )
        oneself = self.users.select("user_id", F.col("user_id").alias("candidate_id"))
        asks = friends.unionByName(friend_of_friend).unionByName(strangers).unionByName(oneself)
        return self._written("requests", asks)

    @cached_property
    def graph_id_map(self) -> DataFrame:
        """Users of the earlier roster, less those whose document got lost (customers in
        debt), and ghost users the roster does not know."""
        lost = self.table("customer").where("c_acctbal < 0").select(_name("u", F.col("c_custkey")).alias("user_id"))
        known = roster.users(roster.relation(self.earlier_roster)).join(lost, "user_id", "left_anti")
        ghosts = self.table("supplier").select(_name("g", F.col("s_suppkey")).alias("user_id"))
        return self._written("graph_id_map", idmap.with_vertex_ids(known.unionByName(ghosts)))

    @cached_property
    def graph_edges(self) -> DataFrame:
        """Edges of the earlier roster, and edges of ghosts and of vertices nobody knows."""
        earlier = roster.friendships(roster.relation(self.earlier_roster)).select(
            F.md5("user_id").alias("src_vid"), F.md5("friend_user_id").alias("dst_vid")
        )
        key = F.col("s_suppkey")
        strays = self.table("supplier").select(
            F.explode(F.array(F.md5(_name("g", key)), F.md5(_name("x", key)))).alias("src_vid"),
            F.md5(_name("u", key)).alias("dst_vid"),
        )
        return self._written("graph_edges", earlier.unionByName(strays))

    @cached_property
    def changes(self) -> DataFrame:
        """Adds and deletes from events, then everybody drops friends in debt."""
        in_debt = self.table("customer").where("c_acctbal < 0").select(
            _name("u", F.col("c_custkey")).alias("friend_user_id"), "c_custkey"
        )
        drops = self.friendships.join(in_debt, "friend_user_id").select(
            "user_id", "friend_user_id", F.lit("delete").alias("op"),
            (F.col("c_custkey") + 1000000000).alias("seq"),
        )
        return self._written("changes", event_changes(self.table("events")).unionByName(drops).unionByName(self._no_calls))

    @cached_property
    def written_event_changes(self) -> DataFrame:
        return self._written("event-changes", event_changes(self.table("events")))

    @property
    def _no_calls(self) -> DataFrame:
        """Rows about existing edges of well-off customers that are no valid call."""
        key = F.col("c_custkey")
        rich = self.table("customer").where("c_acctbal > 8000").select(_name("u", key).alias("user_id"), "c_custkey")
        known = self.friendships.join(rich, "user_id")
        return known.select(
            "user_id", F.when(key % 4 != 2, F.col("friend_user_id")).alias("friend_user_id"),
            F.when(key % 4 == 0, "block").when(key % 4 == 1, "add").otherwise("delete").alias("op"),
            F.when(key % 2 == 0, key + 2000000000).alias("seq"),
        )

    @cached_property
    def loaded(self) -> store.Graph:
        """The graph after the first load, as a job stores it."""
        return jobs.reset_then_load(self.spark, self.relation, session.new_folder(self.spark, "graph"), hot_threshold=HOT_THRESHOLD)

    @cached_property
    def imported(self) -> store.Graph:
        """The stored graph of the earlier roster."""
        return jobs.import_edges(self.spark, self.graph_edges, self.graph_id_map, session.new_folder(self.spark, "imported-graph"))

    @cached_property
    def synced(self) -> store.Graph:
        """The stored graph of the earlier roster after a sync; one sync serves all queries."""
        root = session.new_folder(self.spark, "synced-graph")
        store.fork(self.spark, self.imported, root)
        return jobs.sync(self.spark, self.relation, root)

    @cached_property
    def changed(self) -> store.Graph:
        """The loaded graph after the change calls."""
        root = session.new_folder(self.spark, "changed-graph")
        store.fork(self.spark, self.loaded, root)
        return jobs.apply_changes(self.spark, self.changes, root)

    @property
    def id_map_updates(self) -> DataFrame:
        """Every relation row registers its user anew; the last row of a user wins."""
        return self.relation.select(
            F.col("userId").alias("user_id"),
            F.md5(F.concat("userId", F.lit("#"), F.col("rosterId").cast("string"))).alias("vertex_id"),
            F.col("rosterId").alias("seq"),
        )

    @property
    def id_map_deletes(self) -> DataFrame:
        in_debt = self.table("customer").where("c_acctbal < 0").select(_name("u", F.col("c_custkey")).alias("user_id"))
        unknown = self.table("supplier").select(_name("nobody", F.col("s_suppkey")).alias("user_id"))
        return in_debt.unionByName(unknown)

    @property
    def messy(self) -> DataFrame:
        return self.table("customer").select(
            "c_custkey",
            F.concat(F.lit("\t "), "c_name", F.lit("  ")).alias("s1"),
            F.concat("c_mktsegment", F.lit("\n")).alias("s2"),
        )

    @property
    def maybe_prices(self) -> DataFrame:
        price, key = F.col("o_totalprice"), F.col("o_orderkey")
        null = F.lit(None).cast("double")
        prices = (
            F.when(key % 7 == 0, F.array().cast("array<double>")).when(key % 7 == 1, F.array(null, price))
            .when(key % 7 == 2, F.array(price, price + 1, null)).when(key % 7 != 3, F.array(price))
        )
        return self.table("orders").select("o_orderkey", prices.alias("prices"))


def event_changes(events: DataFrame) -> DataFrame:
    user = F.col("user_id")
    return events.select(
        _name("u", user).alias("user_id"),
        _name("u", user + F.col("event_id") % 5 + 1).alias("friend_user_id"),
        F.when(F.col("event_type") == "error", "delete").otherwise("add").alias("op"),
        F.col("event_id").alias("seq"),
    )
