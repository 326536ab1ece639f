"""The small planted fixture of FIXTURES.md, built in DuckDB from the sf0.001 tables."""

import duckdb

SF_DIR = "/root/testdata/sf0.001"

VIEWS = {
    "view_ofroster": """
        SELECT o_orderkey + 1 AS rosterID,
               'acct' || CAST(o_custkey AS STRING) AS username,
               'acct' || CAST(f AS STRING) AS loginAccount,
               CASE WHEN o_orderkey % 97 = 0 THEN NULL
                    WHEN o_orderkey % 107 = 0 THEN 'u' || CAST((f + 3) % n AS STRING)
                    ELSE 'u' || CAST(CASE WHEN f % 40 = 1 THEN f - 1 ELSE f END AS STRING) END AS userID,
               CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 3 END AS sub
        FROM (SELECT o_orderkey, o_custkey, n, CASE WHEN f0 % 23 = 5 THEN f0 - 1 ELSE f0 END AS f
              FROM (SELECT o_orderkey, o_custkey, n,
                           CASE WHEN o_orderkey % 101 = 0 THEN o_custkey
                                WHEN o_orderkey % 7 = 0 AND o_custkey % 40 = 0 THEN o_custkey + 1
                                WHEN o_orderkey % 3 = 0 AND o_custkey % 150 = 0 THEN o_custkey + 2
                                WHEN o_orderkey % 2 = 0 AND o_custkey % 150 = 2 THEN o_custkey - 2
                                ELSE (o_custkey * 31 + o_orderkey * 17 + 7) % n END AS f0
                    FROM orders, (SELECT count(*) AS n FROM customer) c) p) o""",
    "relation": """
        SELECT rosterID AS rosterId, username, loginAccount, userID AS userId
        FROM view_ofroster WHERE sub = 3 AND userID IS NOT NULL AND username <> loginAccount""",
    "users": "SELECT DISTINCT userId AS user_id FROM relation",
    "friendships": """
        SELECT DISTINCT o.userId AS user_id, r.userId AS friend_user_id
        FROM relation r JOIN (SELECT DISTINCT loginAccount, userId FROM relation) o ON o.loginAccount = r.username""",
    "id_map": "SELECT user_id, md5(user_id) AS vertex_id FROM users",
    "requests": """
        SELECT a.user_id, b.user_id AS candidate_id FROM users a, users b
        WHERE CAST(substr(a.user_id, 2) AS BIGINT) % 50 = 0 AND CAST(substr(b.user_id, 2) AS BIGINT) % 3 = 0""",
    "graph_id_map": """
        SELECT user_id, vertex_id FROM id_map WHERE CAST(substr(user_id, 2) AS BIGINT) % 11 <> 0
        UNION ALL
        SELECT 'g' || CAST(s_suppkey AS STRING), md5('g' || CAST(s_suppkey AS STRING)) FROM supplier""",
    "known_pairs": """
        SELECT CAST(substr(f.user_id, 2) AS BIGINT) AS u, CAST(substr(f.friend_user_id, 2) AS BIGINT) AS v,
               a.vertex_id AS a_vid, b.vertex_id AS b_vid
        FROM friendships f JOIN id_map a ON a.user_id = f.user_id JOIN id_map b ON b.user_id = f.friend_user_id""",
    "graph_edges": """
        SELECT a_vid AS src_vid, b_vid AS dst_vid FROM known_pairs
        WHERE u % 11 <> 0 AND v % 11 <> 0 AND (u + v) % 10 <> 0
        UNION SELECT b_vid, a_vid FROM known_pairs WHERE u % 11 <> 0 AND v % 11 <> 0 AND (u * 7 + v) % 13 = 0
        UNION SELECT md5('g' || CAST(s_suppkey AS STRING)), m.vertex_id
              FROM supplier JOIN graph_id_map m ON m.user_id = 'u' || CAST(s_suppkey AS STRING)
        UNION SELECT a_vid, b_vid FROM known_pairs WHERE (u % 11 = 0 OR v % 11 = 0) AND (u + v) % 5 = 0
        UNION SELECT md5('x' || CAST(s_suppkey AS STRING)), m.vertex_id
              FROM supplier JOIN graph_id_map m ON m.user_id = 'u' || CAST(s_suppkey AS STRING)""",
    "changes": """
        SELECT 'u' || CAST(user_id AS STRING) AS user_id,
               'u' || CAST(user_id + event_id % 5 + 1 AS STRING) AS friend_user_id,
               CASE WHEN event_type = 'error' THEN 'delete' ELSE 'add' END AS op, event_id AS seq
        FROM events
        UNION ALL
        SELECT user_id, friend_user_id, 'delete',
               1000000000 + CAST(substr(user_id, 2) AS BIGINT) * 1000000 + CAST(substr(friend_user_id, 2) AS BIGINT)
        FROM friendships
        WHERE (CAST(substr(user_id, 2) AS BIGINT) + CAST(substr(friend_user_id, 2) AS BIGINT)) % 17 = 0""",
    "id_map_updates": """
        SELECT user_id, md5(user_id || '#1') AS vertex_id, CAST(1 AS BIGINT) AS seq FROM users
        WHERE CAST(substr(user_id, 2) AS BIGINT) % 4 = 0
        UNION ALL SELECT user_id, md5(user_id || '#2'), 2 FROM users WHERE CAST(substr(user_id, 2) AS BIGINT) % 8 = 0
        UNION ALL SELECT 'g' || CAST(s_suppkey AS STRING), md5('g' || CAST(s_suppkey AS STRING)), 1 FROM supplier""",
    "id_map_deletes": """
        SELECT user_id FROM users WHERE CAST(substr(user_id, 2) AS BIGINT) % 9 = 0
        UNION ALL SELECT 'nobody' || CAST(s_suppkey AS STRING) FROM supplier""",
    "seeds": "SELECT user_id FROM graph_id_map WHERE user_id LIKE 'u%0'",
}


class Fixture:
    """Each view as a Spark DataFrame attribute."""

    def __init__(self, spark):
        self._spark = spark
        self._duck = duckdb.connect()
        for table in ("customer", "orders", "supplier", "events"):
            self._duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
        for name, sql in VIEWS.items():
            self._duck.execute(f"CREATE TABLE {name} AS {sql}")

    def __getattr__(self, name):
        return self._spark.createDataFrame(self._duck.table(name).to_arrow_table())
