"""The expected result of every query as SQL over the given tables."""

import re

# The tables and intermediate results, by name; each may use those above it.
_VIEWS = {
    "numbered_orders": """
        SELECT o_orderkey, o_custkey, o_orderstatus, (SELECT count(*) FROM customer) AS n FROM orders""",
    "listed_orders": """
        SELECT *, CASE WHEN o_orderkey % 101 = 0 THEN o_custkey
                       WHEN o_orderkey % 7 = 0 AND o_custkey % 40 = 0 THEN o_custkey + 1
                       WHEN o_orderkey % 3 = 0 AND o_custkey % 150 = 0 THEN o_custkey + 2
                       WHEN o_orderkey % 2 = 0 AND o_custkey % 150 = 2 THEN o_custkey - 2
                       ELSE (o_custkey * 31 + o_orderkey * 17 + 7) % n END AS f0
        FROM numbered_orders""",
    "friend_orders": """
        SELECT *, CASE WHEN f0 % 23 = 5 THEN f0 - 1 ELSE f0 END AS f FROM listed_orders""",
    "all_rosters": """
        SELECT o_orderkey + 1 AS rosterID, 'acct' || o_custkey AS username, 'acct' || f AS loginAccount,
               CASE WHEN o_orderkey % 97 = 0 THEN NULL
                    WHEN o_orderkey % 107 = 0 THEN 'u' || ((f + 3) % n)
                    WHEN f % 40 = 1 THEN 'u' || (f - 1)
                    ELSE 'u' || f END AS userID,
               CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 3 END AS sub,
               CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 3 END AS earlier_sub
        FROM friend_orders""",
    "relation": """
        SELECT rosterID AS rosterId, username, loginAccount, userID AS userId FROM all_rosters
        WHERE sub = 3 AND userID IS NOT NULL AND username <> loginAccount""",
    "users": "SELECT DISTINCT userId AS user_id FROM relation",
    "owner_pairs": """
        SELECT o.userId AS user_id, r.userId AS friend_user_id
        FROM relation r JOIN (SELECT DISTINCT loginAccount, userId FROM relation) o ON o.loginAccount = r.username""",
    "friendships": "SELECT DISTINCT user_id, friend_user_id FROM owner_pairs",
    "id_map": "SELECT user_id, md5(user_id) AS vertex_id FROM users",
    "earlier_relation": """
        SELECT username, loginAccount, userID AS userId FROM all_rosters
        WHERE earlier_sub = 3 AND userID IS NOT NULL AND username <> loginAccount""",
    "earlier_friendships": """
        SELECT DISTINCT o.userId AS user_id, r.userId AS friend_user_id
        FROM earlier_relation r
        JOIN (SELECT DISTINCT loginAccount, userId FROM earlier_relation) o ON o.loginAccount = r.username""",
    "in_debt": "SELECT 'u' || c_custkey AS user_id, c_custkey FROM customer WHERE c_acctbal < 0",
    "graph_id_map": """
        SELECT user_id, md5(user_id) AS vertex_id
        FROM (SELECT userId AS user_id FROM earlier_relation
              EXCEPT SELECT user_id FROM in_debt
              UNION SELECT 'g' || s_suppkey FROM supplier)""",
    "graph_edges": """
        SELECT md5(user_id) AS src_vid, md5(friend_user_id) AS dst_vid FROM earlier_friendships
        UNION ALL SELECT md5('g' || s_suppkey), md5('u' || s_suppkey) FROM supplier
        UNION ALL SELECT md5('x' || s_suppkey), md5('u' || s_suppkey) FROM supplier""",
    "graph_friendships": """
        SELECT a.user_id, b.user_id AS friend_user_id
        FROM graph_edges e JOIN graph_id_map a ON a.vertex_id = e.src_vid
        JOIN graph_id_map b ON b.vertex_id = e.dst_vid""",
    "edge_diff": """
        SELECT g.user_id AS stored_user_id, g.friend_user_id AS stored_friend_user_id,
               f.user_id AS wanted_user_id, f.friend_user_id AS wanted_friend_user_id
        FROM graph_friendships g FULL OUTER JOIN friendships f
             ON f.user_id = g.user_id AND f.friend_user_id = g.friend_user_id
        WHERE f.user_id IS NULL OR g.user_id IS NULL""",
    "synced_id_map": """
        SELECT user_id, vertex_id FROM graph_id_map
        UNION SELECT user_id, md5(user_id) FROM users WHERE user_id NOT IN (SELECT user_id FROM graph_id_map)""",
    "synced_graph": """
        SELECT src_vid, dst_vid FROM graph_edges e
        WHERE NOT EXISTS (SELECT 1 FROM synced_id_map a WHERE a.vertex_id = e.src_vid)
           OR NOT EXISTS (SELECT 1 FROM synced_id_map b WHERE b.vertex_id = e.dst_vid)
        UNION SELECT md5(user_id), md5(friend_user_id) FROM friendships""",
    "requests": """
        SELECT user_id, friend_user_id AS candidate_id FROM friendships
        UNION ALL
        SELECT f.user_id, s.top FROM friendships f
        JOIN (SELECT user_id, max(friend_user_id) AS top FROM friendships GROUP BY user_id) s
             ON s.user_id = f.friend_user_id
        UNION ALL
        SELECT 'u' || o_custkey, 'u' || ((o_custkey * 13 + o_orderkey * 29 + 3) % n) FROM numbered_orders
        UNION ALL
        SELECT user_id, user_id FROM users""",
    "asks": "SELECT DISTINCT user_id, candidate_id FROM requests",
    "registered_asks": """
        SELECT a.* FROM asks a JOIN id_map x ON x.user_id = a.user_id JOIN id_map y ON y.user_id = a.candidate_id""",
    "one_degree": """
        SELECT a.user_id, a.candidate_id FROM registered_asks a
        JOIN friendships f ON f.user_id = a.user_id AND f.friend_user_id = a.candidate_id""",
    "two_hops": """
        SELECT a.user_id, a.candidate_id, f.friend_user_id AS common_id
        FROM asks a JOIN friendships f ON f.user_id = a.user_id
        JOIN friendships g ON g.user_id = f.friend_user_id AND g.friend_user_id = a.candidate_id""",
    "common_friends": """
        SELECT h.* FROM two_hops h JOIN registered_asks a ON a.user_id = h.user_id AND a.candidate_id = h.candidate_id
        WHERE h.user_id <> h.candidate_id""",
    "two_degree": """
        SELECT DISTINCT c.user_id, c.candidate_id FROM common_friends c
        WHERE NOT EXISTS (SELECT 1 FROM friendships f
                          WHERE f.user_id = c.user_id AND f.friend_user_id = c.candidate_id)""",
    "event_changes": """
        SELECT 'u' || user_id AS user_id, 'u' || (user_id + event_id % 5 + 1) AS friend_user_id,
               CASE WHEN event_type = 'error' THEN 'delete' ELSE 'add' END AS op, event_id AS seq
        FROM events""",
    "changes": """
        SELECT * FROM event_changes
        UNION ALL
        SELECT f.user_id, f.friend_user_id, 'delete', 1000000000 + d.c_custkey
        FROM friendships f JOIN in_debt d ON d.user_id = f.friend_user_id""",
    "no_calls": """
        SELECT f.user_id, CASE WHEN c_custkey % 4 <> 2 THEN f.friend_user_id END AS friend_user_id,
               CASE c_custkey % 4 WHEN 0 THEN 'block' WHEN 1 THEN 'add' ELSE 'delete' END AS op,
               CASE WHEN c_custkey % 2 = 0 THEN 2000000000 + c_custkey END AS seq
        FROM friendships f JOIN customer c ON 'u' || c.c_custkey = f.user_id WHERE c_acctbal > 8000""",
    "ranked_changes": """
        SELECT *, row_number() OVER (PARTITION BY user_id, friend_user_id ORDER BY seq DESC, op DESC) AS age
        FROM changes""",
    "ranked_event_changes": """
        SELECT *, row_number() OVER (PARTITION BY user_id, friend_user_id ORDER BY seq DESC, op DESC) AS age
        FROM event_changes""",
    "after_changes": """
        SELECT user_id, friend_user_id FROM friendships f
        WHERE NOT EXISTS (SELECT 1 FROM changes c WHERE c.user_id = f.user_id AND c.friend_user_id = f.friend_user_id)
        UNION
        SELECT user_id, friend_user_id FROM ranked_changes WHERE age = 1 AND op = 'add'""",
    "users_after": """
        SELECT user_id FROM users
        UNION SELECT user_id FROM changes WHERE op = 'add'
        UNION SELECT friend_user_id FROM changes WHERE op = 'add'""",
    "ranked_updates": """
        SELECT userId AS user_id, md5(userId || '#' || rosterId) AS vertex_id,
               row_number() OVER (PARTITION BY userId ORDER BY rosterId DESC) AS age
        FROM relation""",
    "out_degrees": "SELECT user_id, count(*) AS n_friends FROM friendships GROUP BY user_id",
    "in_degrees": "SELECT friend_user_id AS user_id, count(*) AS n_friends FROM friendships GROUP BY friend_user_id",
    "messy": """
        SELECT c_custkey, chr(9) || ' ' || c_name || '  ' AS s1, c_mktsegment || chr(10) AS s2 FROM customer""",
    "maybe_prices": """
        SELECT o_orderkey, CASE WHEN o_orderkey % 7 IN (0, 3) THEN -1.0 WHEN o_orderkey % 7 <> 1 THEN o_totalprice END AS price
        FROM orders""",
}

_TRIMMED = r"regexp_replace({}, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')"

_AFTER_EVENTS = """
    SELECT user_id, friend_user_id FROM friendships f
    WHERE NOT EXISTS (SELECT 1 FROM event_changes c
                      WHERE c.user_id = f.user_id AND c.friend_user_id = f.friend_user_id)
    UNION
    SELECT user_id, friend_user_id FROM ranked_event_changes WHERE age = 1 AND op = 'add'"""

_QUERIES = {
    "max_roster_id": "SELECT max(rosterID) AS max_roster_id FROM all_rosters",
    "relation": "SELECT * FROM relation",
    "users": "SELECT * FROM users",
    "friendships": "SELECT * FROM friendships",
    "id_map": "SELECT * FROM id_map",
    "id_map_in_store": "SELECT * FROM id_map",
    "missing_users": "SELECT user_id FROM users EXCEPT SELECT user_id FROM graph_id_map",
    "id_map_upsert": """
        SELECT user_id, vertex_id FROM graph_id_map WHERE user_id NOT IN (SELECT userId FROM relation)
        UNION ALL SELECT user_id, vertex_id FROM ranked_updates WHERE age = 1""",
    "id_map_delete": """
        SELECT user_id, vertex_id FROM id_map
        WHERE user_id NOT IN (SELECT user_id FROM in_debt UNION ALL SELECT 'nobody' || s_suppkey FROM supplier)""",
    "resolve_ids_left": """
        SELECT r.userId AS user_id, m.vertex_id FROM relation r LEFT JOIN graph_id_map m ON m.user_id = r.userId""",
    "resolve_ids_inner": """
        SELECT r.userId AS user_id, m.vertex_id FROM relation r JOIN graph_id_map m ON m.user_id = r.userId""",
    "duplicate_user_ids": """
        SELECT userId AS user_id, count(*) AS n_rows FROM relation GROUP BY userId HAVING count(*) > 1""",
    "duplicate_edges": """
        SELECT user_id, friend_user_id, count(*) AS n_rows FROM owner_pairs
        GROUP BY user_id, friend_user_id HAVING count(*) > 1""",
    "vid_edges": """
        SELECT a.vertex_id AS src_vid, b.vertex_id AS dst_vid
        FROM friendships f JOIN id_map a ON a.user_id = f.user_id JOIN id_map b ON b.user_id = f.friend_user_id""",
    "graph_vid_edges": """
        SELECT src_vid, dst_vid FROM graph_edges WHERE src_vid IN (SELECT vertex_id FROM graph_id_map)""",
    "graph_friendships": "SELECT * FROM graph_friendships",
    "edge_diff": "SELECT * FROM edge_diff",
    "stale_edges": """
        SELECT stored_user_id AS user_id, stored_friend_user_id AS friend_user_id
        FROM edge_diff WHERE stored_user_id IS NOT NULL""",
    "missing_edges": """
        SELECT wanted_user_id AS user_id, wanted_friend_user_id AS friend_user_id
        FROM edge_diff WHERE wanted_user_id IS NOT NULL""",
    "reset_then_load": "SELECT * FROM friendships",
    "synced_users": "SELECT user_id FROM synced_id_map",
    "synced_edges": """
        SELECT a.user_id, b.user_id AS friend_user_id
        FROM synced_graph e JOIN synced_id_map a ON a.vertex_id = e.src_vid
        JOIN synced_id_map b ON b.vertex_id = e.dst_vid""",
    "synced_graph": "SELECT * FROM synced_graph",
    "neighbours": """
        SELECT m.user_id, e.dst_vid AS friend_vid
        FROM users u JOIN graph_id_map m ON m.user_id = u.user_id JOIN graph_edges e ON e.src_vid = m.vertex_id""",
    "one_degree": "SELECT * FROM one_degree",
    "two_degree": "SELECT * FROM two_degree",
    "friend_levels": """
        SELECT user_id, candidate_id, 1 AS level FROM one_degree
        UNION ALL SELECT user_id, candidate_id, 2 FROM two_degree""",
    "common_friend_count": """
        SELECT user_id, candidate_id, count(*) AS n_common FROM common_friends GROUP BY user_id, candidate_id""",
    "common_friends": "SELECT * FROM common_friends",
    "common_friends_set": """
        SELECT user_id, candidate_id, CAST('0x' || substr(md5(common_id), 1, 8) AS BIGINT) % 4 AS chunk,
               string_agg(common_id, ',' ORDER BY common_id) AS common_ids
        FROM common_friends GROUP BY ALL""",
    "common_friends_pair": """
        SELECT h.* FROM two_hops h JOIN id_map m ON m.user_id = h.candidate_id""",
    "hot_users": """
        SELECT user_id, n_friends FROM out_degrees WHERE n_friends >= 12""",
    "hot_users_flagged": "SELECT user_id FROM out_degrees WHERE n_friends >= 12",
    "friendships_by_view": "SELECT * FROM friendships",
    "edges_after_changes": "SELECT * FROM after_changes",
    "rejected_changes": """
        SELECT *, CASE WHEN friend_user_id IS NULL THEN 'no user' WHEN op = 'block' THEN 'unknown op' ELSE 'no seq' END AS reason
        FROM no_calls WHERE friend_user_id IS NULL OR op = 'block' OR seq IS NULL""",
    "graph_after_changes": "SELECT md5(user_id) AS src_vid, md5(friend_user_id) AS dst_vid FROM after_changes",
    "people_after_changes": """
        SELECT u.user_id, TRUE AS registered, coalesce(o.n, 0) AS out_degree, coalesce(i.n, 0) AS in_degree
        FROM users_after u
        LEFT JOIN (SELECT user_id, count(*) AS n FROM after_changes GROUP BY ALL) o ON o.user_id = u.user_id
        LEFT JOIN (SELECT friend_user_id, count(*) AS n FROM after_changes GROUP BY ALL) i ON i.friend_user_id = u.user_id""",
    "edges_after_delete": """
        SELECT user_id, friend_user_id FROM friendships
        EXCEPT SELECT user_id, friend_user_id FROM changes WHERE op = 'delete'""",
    "users_after_changes": "SELECT * FROM users_after",
    "edges_after_change_stream": _AFTER_EVENTS,
    "edges_after_compaction": _AFTER_EVENTS,
    "edges_after_two_compactions": _AFTER_EVENTS,
    "edges_after_live_calls": _AFTER_EVENTS,
    "degrees_after_two_logs": """
        SELECT u.user_id, coalesce(o.n, 0) AS out_degree, coalesce(i.n, 0) AS in_degree
        FROM users_after u
        LEFT JOIN (SELECT user_id, count(*) AS n FROM after_changes GROUP BY ALL) o ON o.user_id = u.user_id
        LEFT JOIN (SELECT friend_user_id, count(*) AS n FROM after_changes GROUP BY ALL) i ON i.friend_user_id = u.user_id""",
    "hot_users_after_changes": """
        SELECT user_id FROM after_changes GROUP BY user_id HAVING count(*) >= 12""",
    "price_rounded": """
        SELECT l_orderkey, l_linenumber,
               CAST(round(CAST(l_extendedprice AS DECIMAL(20, 6)), 1) AS DOUBLE) AS price FROM lineitem""",
    "price_truncated": """
        SELECT l_orderkey, l_linenumber,
               CAST(trunc(CAST(l_extendedprice AS DECIMAL(20, 6)), 1) AS DOUBLE) AS price FROM lineitem""",
    "trimmed_array": f"""
        SELECT c_custkey, {_TRIMMED.format('s1')} AS text FROM messy
        UNION ALL SELECT c_custkey, {_TRIMMED.format('s2')} FROM messy""",
    "trimmed_row": f"""
        SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, {_TRIMMED.format('s1')} AS s1, {_TRIMMED.format('s2')} AS s2
        FROM messy""",
    "first_or_default": """
        SELECT o_orderkey, price, CAST(trunc(price) AS INTEGER) AS whole_price,
               CASE WHEN price = -1.0 THEN -1.0 ELSE CAST(round(CAST(price AS DECIMAL(20, 6)), 2) AS DOUBLE) END AS rounded_price
        FROM maybe_prices""",
}


def oracle_sql() -> dict[str, str]:
    return {name: _with_views(query) for name, query in _QUERIES.items()}


def _with_views(query: str) -> str:
    """Put the views a query uses, directly or not, in front of it."""
    needed, open_texts = set(), [query]
    while open_texts:
        words = set(re.findall(r"\w+", open_texts.pop()))
        new = (words & _VIEWS.keys()) - needed
        needed |= new
        open_texts += [_VIEWS[name] for name in new]
    views = [f"{name} AS ({sql})" for name, sql in _VIEWS.items() if name in needed]
    return f"WITH {', '.join(views)} {query}" if views else query
