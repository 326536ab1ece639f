"""Questions about pairs of users: friend level, number and list of common friends.

All functions take ``requests(user_id, candidate_id)`` of any size, the edge table
``friendships(user_id, friend_user_id)`` with each pair once (what ``roster.friendships``
and ``changes.apply_changes`` return), and the table ``people`` built by ``people()`` and
written by the caller. Answers come as rows; a pair without an answer has no row.

The two-hop questions all need the middles m with u -> m -> c. A request can list u's
friends and look up m -> c, or list those who know c and look up u -> m. Each request
takes the shorter list, so no request pays for a hub if its other end is no hub, and a
user with a third of all edges costs at most one pass over the edges for all requests
together. Requests are never paired with each other and no two-hop path is built that no
request asks for.

Most listed rows are no path. A request whose two lists are of a like length therefore takes
16 bits of a hash of each of its user's friends along, and only those who know the candidate
and have one of these hashes are shuffled on. The check on whole edges follows for all rows,
so hashes decide nothing; requests without them are listed as said above.
"""

from pyspark.sql import Column, DataFrame, functions as F

ASK = ["user_id", "candidate_id"]
OUT, IN, DIRECT = 1, 2, 3
# Requests take hashes along of at most so many friends, and if the other list is at most so many times as long.
MOST_HASHES, TIMES_AS_LONG = 256, 4


def people(friendships: DataFrame, id_map: DataFrame) -> DataFrame:
    """Per user: registered in the id map or not, number of out- and in-edges."""
    def entry(user, registered, n_out, n_in):
        return F.struct(
            F.col(user).alias("user_id"), F.lit(registered).alias("registered"),
            F.lit(n_out).cast("long").alias("out_degree"), F.lit(n_in).cast("long").alias("in_degree"),
        )

    ends = friendships.select(F.inline(F.array(
        entry("user_id", False, 1, 0), entry("friend_user_id", False, 0, 1)
    )))
    known = id_map.select(entry("user_id", True, 0, 0).alias("entry")).select("entry.*")
    return ends.unionByName(known).groupBy("user_id").agg(
        F.max("registered").alias("registered"),
        F.sum("out_degree").alias("out_degree"),
        F.sum("in_degree").alias("in_degree"),
    )


def one_degree(requests: DataFrame, friendships: DataFrame, people: DataFrame) -> DataFrame:
    """Requests whose candidate is a direct friend; with a self edge also the user."""
    direct = _asks(requests).join(_edges(friendships), _is_edge(), "left_semi")
    return _sized(direct, people).select(*ASK)


def two_degree(requests: DataFrame, friendships: DataFrame, people: DataFrame) -> DataFrame:
    """Requests whose candidate is a friend's friend, no direct friend and not the user."""
    others = _asks(requests).where(_not_oneself()).join(_edges(friendships), _is_edge(), "left_anti")
    return _middles(_sized(others, people), friendships).select(*ASK).distinct()


def friend_levels(requests: DataFrame, friendships: DataFrame, people: DataFrame) -> DataFrame:
    """Level 1 or 2 of every request that has one, in one pass over the requests.

    A direct friend travels along with no middle to look for and passes the final edge
    check on its own pair, so the requests are shuffled and joined once for both levels.
    """
    flagged = _asks(requests).join(_edges(friendships), _is_edge(), "left")
    asks = flagged.select(*ASK, F.col("known").isNotNull().alias("direct"))
    open_asks = _sized(asks.where(F.col("direct") | _not_oneself()), people)
    middles = _middles(open_asks, friendships, "direct", direct_for=people)
    level = F.when(F.col("direct"), 1).otherwise(2)
    return middles.select(*ASK, level.alias("level")).distinct()


def common_friend_count(requests: DataFrame, friendships: DataFrame, people: DataFrame) -> DataFrame:
    """Number of m with user -> m -> candidate. Direct friends count, oneself does not."""
    paths = common_friends(requests, friendships, people)
    return paths.groupBy(*ASK).agg(F.count("*").alias("n_common"))


def common_friends(requests: DataFrame, friendships: DataFrame, people: DataFrame) -> DataFrame:
    """Every m with user -> m -> candidate, one row each; the user itself is no candidate."""
    asks = _sized(_asks(requests).where(_not_oneself()), people)
    return _middles(asks, friendships).select(*ASK, F.col("middle").alias("common_id"))


def common_friends_set(requests: DataFrame, friendships: DataFrame, people: DataFrame, chunks: int) -> DataFrame:
    """Common friends as sorted sets; a pair's set is spread over ``chunks`` rows by a hash of the friend.

    The number holds for all pairs alike: a pair has up to that many rows, numbered by ``chunk``, and all
    of them together are the whole set. Choose it so that the largest set of one pair, a share of
    the longest friend list, fits a task when it is divided by it; ``common_friends`` has no such limit.
    """
    number = F.conv(F.substring(F.md5("common_id"), 1, 8), 16, 10).cast("long")
    rows = common_friends(requests, friendships, people).withColumn("chunk", F.pmod(number, F.lit(chunks)))
    return rows.groupBy(*ASK, "chunk").agg(
        F.array_join(F.sort_array(F.collect_set("common_id")), ",").alias("common_ids")
    )


def common_friends_pair(requests: DataFrame, friendships: DataFrame, people: DataFrame) -> DataFrame:
    """Common friends as ``common_friends``, but a user may ask about itself and need not be registered."""
    asks = _sized(_asks(requests), people, user_registered=False)
    return _middles(asks, friendships).select(*ASK, F.col("middle").alias("common_id"))


def _asks(requests: DataFrame) -> DataFrame:
    return requests.select(*ASK).distinct()


def _not_oneself() -> Column:
    return F.col("user_id") != F.col("candidate_id")


def _edges(friendships: DataFrame) -> DataFrame:
    """The edges to look pairs up in; the same columns each time, so that one shuffle serves all look-ups."""
    return friendships.select(F.col("user_id").alias("knower"), F.col("friend_user_id").alias("known"))


def _is_edge() -> Column:
    return (F.col("user_id") == F.col("knower")) & (F.col("candidate_id") == F.col("known"))


def _sized(asks: DataFrame, people: DataFrame, user_registered: bool = True) -> DataFrame:
    """Keep asks between people who can have an answer, with the length of both friend lists."""
    asked = people.where(F.col("registered") & (F.col("in_degree") > 0)).select(
        F.col("user_id").alias("candidate_id"), "in_degree"
    )
    asking = people.where(F.col("out_degree") > 0)
    if user_registered:
        asking = asking.where("registered")
    return asks.join(asked, "candidate_id").join(asking.select("user_id", "out_degree"), "user_id")


def _middles(asks: DataFrame, friendships: DataFrame, *carried: str, direct_for: DataFrame | None = None) -> DataFrame:
    """The middles of every ask's two-hop paths as (user_id, candidate_id, middle, *carried)."""
    via = F.col("via")
    steps = _steps(asks, friendships, *carried, direct_for=direct_for)
    return steps.join(_edges(friendships), ["knower", "known"], "left_semi").select(
        F.when(via == OUT, F.col("far")).otherwise(F.col("knower")).alias("user_id"),
        F.when(via == OUT, F.col("known")).otherwise(F.col("far")).alias("candidate_id"),
        F.when(via == OUT, F.col("knower")).otherwise(F.col("known")).alias("middle"),
        *carried,
    )


def _steps(asks: DataFrame, friendships: DataFrame, *carried: str, direct_for: DataFrame | None = None) -> DataFrame:
    """What is listed for asks and needs a check: an edge (knower, known) and the third user of the path (far).

    An ask goes ``via`` the friends of its user (OUT) or those who know its candidate (IN).
    With ``direct_for``, a table of all users, asks flagged ``direct`` go via one row of
    their user (DIRECT): nothing is listed and the check gets their own pair. That keeps
    the join an inner join, which can split a hot key on either side.

    Listed rows are the largest data of the job, so those without the hash of a friend stay behind.
    """
    via, user, candidate, middle, anchor, far = map(F.col, ("via", "user_id", "candidate_id", "middle", "anchor", "far"))
    asks = asks.join(_friend_hashes(friendships), "user_id", "left")
    hashes = F.when(F.col("in_degree") <= TIMES_AS_LONG * F.col("out_degree"), F.col("hashes"))
    takes = F.when(hashes.isNotNull(), IN).when(F.col("out_degree") <= F.col("in_degree"), OUT).otherwise(IN)
    ends = friendships.select(F.inline(F.array(
        F.struct(F.lit(OUT).alias("via"), user.alias("anchor"), F.col("friend_user_id").alias("middle")),
        F.struct(F.lit(IN).alias("via"), F.col("friend_user_id").alias("anchor"), user.alias("middle")),
    )))
    if direct_for is not None:
        takes = F.when(F.col("direct"), DIRECT).otherwise(takes)
        hashes = F.when(~F.col("direct"), hashes)
        ends = ends.unionByName(direct_for.select(
            F.lit(DIRECT).alias("via"), user.alias("anchor"), F.lit(None).cast("string").alias("middle")
        ))
    taken = asks.select(*ASK, *carried, takes.alias("via"), hashes.alias("hashes"))
    anchored = taken.select(
        "via", *carried, "hashes",
        F.when(via == IN, candidate).otherwise(user).alias("anchor"),
        F.when(via == IN, user).otherwise(candidate).alias("far"),
    )
    may_be_friend = F.col("hashes").isNull() | F.array_contains("hashes", _hash(middle))
    return anchored.join(ends, ["via", "anchor"]).where(may_be_friend).select(
        "via", *carried,
        F.when(via == OUT, middle).when(via == IN, far).otherwise(anchor).alias("knower"),
        F.when(via == IN, middle).otherwise(far).alias("known"),
        F.when(via == DIRECT, far).otherwise(anchor).alias("far"),
    )


def _hash(user: Column) -> Column:
    return (F.pmod(F.xxhash64(user), F.lit(1 << 16)) - (1 << 15)).cast("short")


def _friend_hashes(friendships: DataFrame) -> DataFrame:
    """(user_id, hashes): the distinct hashes of everybody's friends, NULL where they are many. A hub has 65,536 of them at most."""
    found = friendships.groupBy("user_id").agg(F.collect_set(_hash(F.col("friend_user_id"))).alias("hashes"))
    return found.select("user_id", F.when(F.size("hashes") <= MOST_HASHES, F.col("hashes")).alias("hashes"))
