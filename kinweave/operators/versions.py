"""What is known about a pair over time, so that calls may arrive in any order and in any number of logs.

A version holds four numbers about one ordered pair, each the largest seen:

| column | |
| --- | --- |
| forced | 2 * epoch + 1 where a load or sync of that epoch put the edge there, 2 * epoch where it dropped it |
| upto | seq of the last call that load or sync knew of; calls up to it are history |
| added, deleted | seq of the last add and the last delete call |

Versions of one pair merge by the maximum of each column. That is associative, commutative and
idempotent: logs may be split, repeated and merged in any order and give the whole log's result. A pair
without an edge keeps its version (a tombstone), as an older call may still arrive.
"""

from pyspark.sql import Column, DataFrame, functions as F

from kinweave.operators.changes import PAIR, calls

VALUES = ("forced", "upto", "added", "deleted")


def _unknown(*names: str) -> list[Column]:
    return [F.lit(None).cast("long").alias(name) for name in names]


def is_present(prefix: str = "") -> Column:
    """Whether the edge is there, from columns whose names may have a prefix.

    Without a call behind ``upto`` a load or sync decides; at equal seq a delete wins.
    """
    forced, upto, added, deleted = (F.col(prefix + name) for name in VALUES)
    added, deleted = (F.when(upto.isNull() | (seq > upto), seq) for seq in (added, deleted))
    called = added.isNotNull() & F.coalesce(added > deleted, F.lit(True))
    forced = F.coalesce(forced % 2 == 1, F.lit(False))
    return F.when(added.isNotNull() | deleted.isNotNull(), called).otherwise(forced)


def last_seq() -> Column:
    """The seq of the last call on the pair, NULL if there was none."""
    return F.greatest("upto", "added", "deleted")


def says_nothing() -> Column:
    """No edge and no call: the version of a pair nobody has heard of."""
    return ~is_present() & last_seq().isNull()


def of_edges(edges: DataFrame, epoch: int = 0) -> DataFrame:
    """Versions of edges that a load found."""
    return edges.select(*PAIR, F.lit(2 * epoch + 1).cast("long").alias("forced"), *_unknown(*VALUES[1:]))


def of_calls(changes: DataFrame) -> DataFrame:
    """Versions of the pairs a log calls, one row a pair."""
    return merge(calls(changes).select(*PAIR, *_unknown("forced", "upto"), "added", "deleted"))


def merge(*versions: DataFrame) -> DataFrame:
    """One version a pair: a hash aggregate of numbers that collapses before the shuffle."""
    rows = versions[0].select(*PAIR, *VALUES)
    for other in versions[1:]:
        rows = rows.unionByName(other.select(*PAIR, *VALUES))
    return rows.groupBy(*PAIR).agg(*[F.max(name).alias(name) for name in VALUES])


def current(versions: DataFrame) -> DataFrame:
    """The pairs with an edge, from one version a pair."""
    return versions.where(is_present()).select(*PAIR)


def apply_changes(versions: DataFrame, changes: DataFrame) -> DataFrame:
    """The edge set after calls that may be older than some the versions already hold."""
    return current(merge(versions, of_calls(changes)))
