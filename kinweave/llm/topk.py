"""Exact top-k search by inner product with MaxScore.

Terms are the vectors' dimensions. In a shard of rows, every dimension of a query has a bound on what
it can add: the query's weight times the largest (for a negative weight the smallest) value of the
shard. The dimensions are split by these bounds: the non-essential ones are those whose bounds, added
to the least the others give, cannot bring a row up to the query's threshold, its k-th best score so
far. Only the essential part is computed for all rows; the rows that may still reach the threshold
are then probed in the non-essential dimensions, largest bound first, and leave as soon as they
cannot. Rows that could tie stay, so ties are decided by id alone.

Queries and rows meet in blocks: rows form shards of SHARD_ROWS, shards form runs, and a block of
queries visits each run once, carrying its thresholds from shard to shard. So that no visit begins without a threshold,
each block first meets one shard: a query's k-th best score there is the floor of all its visits, as more rows can only
raise it. Then it visits about the square root of the runs, whose merged k-th best scores are the floors for all other runs. A visit gives
only rows that reach its query's threshold, at most k of them, which are merged by a window per query: of R runs
that is in the order of k * sqrt(R) rows a query. Visits count the products of components they compute (``top_k_and_work``).

Defined cases: a vector that is null, empty, or holds null or a number that is not finite when scaled takes no part. Vectors
of another length than the query's are no candidates of it. Repeated rows are rows of their own; a
query's own rows are all those with its id, and they are no candidates. Equal queries are one; queries of one id
with different vectors share one list. Scores beyond the 64-bit range
are clipped to it. Columns other than id and vector are not read.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from kinweave.llm.tables import ship_package, written

SHARD_ROWS, QUERY_ROWS = 2048, 256
RUN_SHARDS = 4
PROBE = 8
LONGEST, EXACT = 2 ** 63 - 1, 2 ** 53
SEEDED = pa.schema([("block", pa.int64()), ("width", pa.int32()), ("ids", pa.binary()), ("data", pa.binary()), ("floors", pa.list_(pa.float64()))])
FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def usable(vectors: DataFrame, id_column: str, vector_column: str, scale: int) -> DataFrame:
    """(vec_id, values) of the vectors that take part."""
    finite = F.forall(vector_column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * float(scale)) < float("inf")))
    taking_part = F.col(id_column).isNotNull() & (F.size(vector_column) > 0) & finite
    return vectors.where(taking_part).select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("values"))


def in_blocks(rows: DataFrame, block_rows: int, scale: int) -> DataFrame:
    """(width, ids, data): blocks of about ``block_rows`` rows of one width, as bytes of 64-bit numbers.

    Components become floor(scale * component). Rows are dealt to blocks by their place in the table.
    """
    blocks = max(1, math.ceil(rows.count() / block_rows))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)))

    def pack(table: pa.Table) -> pa.Table:
        lists = table["values"].combine_chunks()
        widths, ids = np.diff(np.asarray(lists.offsets)), np.asarray(table["vec_id"])
        out = []
        for width in np.unique(widths).tolist():
            places = np.flatnonzero(widths == width)
            data = np.floor(np.asarray(lists.take(pa.array(places)).flatten(), np.float64) * float(scale))
            out.append((width, ids[places].astype("<i8").tobytes(), data.astype("<f8").tobytes()))
        columns = list(zip(*out))
        return pa.table({"width": pa.array(columns[0], pa.int32()), "ids": pa.array(columns[1], pa.binary()),
                         "data": pa.array(columns[2], pa.binary())})

    ship_package(rows.sparkSession)
    return dealt.groupBy("block").applyInArrow(pack, "width int, ids binary, data binary")


def _matrix(ids: bytes, data: bytes) -> tuple[np.ndarray, np.ndarray]:
    names = np.frombuffer(ids, "<i8")
    return names, np.frombuffer(data, "<f8").reshape(len(names), -1)


class Best:
    """The k best (score, id) of one query so far: by score, then by smaller id."""

    def __init__(self, k: int, floor: float = -math.inf):
        self.k, self.floor, self.scores, self.ids = k, floor, np.empty(0), np.empty(0, np.int64)

    @property
    def threshold(self) -> float:
        """What a row must reach: rows below it cannot be among the k best, ties with it can."""
        return max(self.floor, self.scores[-1]) if len(self.scores) == self.k else self.floor

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        order = np.lexsort([ids, -scores])[:self.k]
        self.scores, self.ids = scores[order], ids[order]


def search_shard(query: np.ndarray, own: int, ids: np.ndarray, rows: np.ndarray, low: np.ndarray, high: np.ndarray,
                 best: Best) -> int:
    """Add what one shard has for one query; returns how many products of components were computed.

    All numbers are whole and every sum stays below 2 ** 53 here, so doubles are exact.
    """
    at_most = np.maximum(query * low, query * high)
    at_least = np.minimum(query * low, query * high)
    order = np.argsort(at_least - at_most)  # widest range first
    threshold = best.threshold
    # reach[j]: the most that all dimensions from the j-th on can give
    reach = np.append(np.cumsum(at_most[order][::-1])[::-1], 0.0)
    if reach[0] < threshold:
        return 0
    # essential: as many dimensions as needed until the others, at their best, cannot lift a row with
    # the least of the essential part to the threshold
    least = np.append(0.0, np.cumsum(at_least[order]))
    essential = int(np.argmax(least + reach < threshold)) if (least + reach < threshold).any() else len(order)
    partial = rows[:, order[:essential]] @ query[order[:essential]]
    work = essential * len(rows)
    alive = np.flatnonzero(partial + reach[essential] >= threshold)
    partial = partial[alive]
    while essential < len(order) and len(alive):
        part = order[essential:essential + PROBE]
        partial = partial + rows[np.ix_(alive, part)] @ query[part]
        work += len(part) * len(alive)
        essential += len(part)
        competing = partial + reach[essential] >= threshold
        alive, partial = alive[competing], partial[competing]
    others = ids[alive] != own
    best.add(partial[others], ids[alive[others]])
    return work


def search_exactly(query: np.ndarray, own: int, ids: np.ndarray, rows: np.ndarray, best: Best) -> None:
    """As ``search_shard`` for numbers of any size, in Python integers; scores are clipped to 64 bits."""
    wanted = [int(x) for x in query]
    scores = [max(-LONGEST - 1, min(LONGEST, sum(a * int(b) for a, b in zip(wanted, row)))) for row in rows]
    kept = sorted((-score, int(i)) for score, i in zip(scores, ids) if i != own)
    merged = sorted(kept + [(-int(s), int(i)) for s, i in zip(best.scores, best.ids)])[:best.k]
    best.scores = np.array([-s for s, _ in merged], object)
    best.ids = np.array([i for _, i in merged], np.int64)


def search_block(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, best: list[Best]) -> int:
    """Add what one shard has for a block of queries; returns how many products of components were computed."""
    low, high = rows.min(axis=0), rows.max(axis=0)
    size = max(np.abs(rows).max(), 1) * max(np.abs(queries).max(), 1) * rows.shape[1]
    work = 0
    for at, query in enumerate(queries):
        if size < 2.0 ** 52 and best[at].scores.dtype != object:
            work += search_shard(query, query_ids[at], ids, rows, low, high, best[at])
        else:
            search_exactly(query, query_ids[at], ids, rows, best[at])
            work += rows.size
    return work


def with_floors(asked: DataFrame, shards: DataFrame, k: int) -> DataFrame:
    """block, width, ids, data, floors: blocks of queries with each query's k-th best score in one shard of its width."""
    first = shards.groupBy("width").agg(F.min_by(F.struct("ids", "data"), F.xxhash64("ids")).alias("first"))
    met = asked.withColumn("block", F.monotonically_increasing_id()).join(
        first.select("width", F.col("first.ids").alias("some_ids"), F.col("first.data").alias("some_data")), "width", "left")

    def seed(batches):
        for batch in batches:
            for row in batch.to_pylist():
                query_ids, queries = _matrix(row["ids"], row["data"])
                best = [Best(k) for _ in query_ids]
                if row["some_ids"] is not None:
                    search_block(query_ids, queries, *_matrix(row["some_ids"], row["some_data"]), best)
                # scores beyond the range of exact doubles set no floor
                row["floors"] = [float(b.threshold) if b.scores.dtype != object else -math.inf for b in best]
                yield pa.RecordBatch.from_pylist([row], SEEDED)

    ship_package(asked.sparkSession)
    return met.mapInArrow(seed, "block long, width int, ids binary, data binary, floors array<double>")


def raised_floors(asked: DataFrame, hits: DataFrame, k: int) -> DataFrame:
    """``asked`` with floors raised to the k-th best score of each query's hits so far."""
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    reached = hits.withColumn("rank", rank).where((F.col("rank") == k) & F.col("score").between(-EXACT, EXACT)).select(
        "query_id", F.col("score").cast("double").alias("reached"))

    def name(batches):
        for batch in batches:
            for block, ids, floors in zip(*(batch[c].to_pylist() for c in ("block", "ids", "floors"))):
                yield pa.RecordBatch.from_arrays([
                    pa.array([block] * len(floors), pa.int64()), pa.array(range(len(floors)), pa.int32()),
                    pa.array(np.frombuffer(ids, "<i8")), pa.array(floors, pa.float64())], ["block", "place", "query_id", "floor"])

    named = asked.select("block", "ids", "floors").mapInArrow(name, "block long, place int, query_id long, floor double")
    raised = named.join(reached, "query_id", "left").select("block", F.struct("place", F.greatest("floor", "reached").alias("floor")).alias("f"))
    lists = raised.groupBy("block").agg(F.transform(F.sort_array(F.collect_list("f")), lambda f: f["floor"]).alias("floors"))  # QUERY_ROWS each
    return asked.drop("floors").join(lists, "block")


def visits(asked: DataFrame, placed: DataFrame, k: int, runs: str) -> DataFrame:
    """(query_id, vec_id, score) of what each block of queries finds in each run of ``runs``, SQL for an array, and rows without id of its work."""
    visiting = asked.select("width", F.col("ids").alias("query_ids"), F.col("data").alias("query_data"), "floors",
                            F.explode(F.expr(runs)).alias("run"))
    # A merge join streams the query blocks, so that each meets the shards of a run one after the other. In another order
    # thresholds would begin at their floors more often, and nothing else would change.
    met = visiting.hint("merge").join(placed, ["run", "width"]).select("run", "query_ids", "query_data", "floors", "ids", "data")

    def visit(batches):
        current, blocks, best, work, possible = None, None, [], 0, 0
        for batch in batches:
            for row in batch.to_pylist():
                if (row["run"], row["query_ids"]) != current:
                    if current:
                        yield _found(blocks[0], best)
                    current = row["run"], row["query_ids"]
                    blocks = _matrix(row["query_ids"], row["query_data"])
                    best = [Best(k, floor) for floor in row["floors"]]
                ids, rows = _matrix(row["ids"], row["data"])
                work += search_block(*blocks, ids, rows, best)
                possible += len(blocks[0]) * rows.size
        if current:
            yield _found(blocks[0], best)
            yield pa.RecordBatch.from_pylist([{"query_id": None, "vec_id": work, "score": possible}], FOUND)

    ship_package(asked.sparkSession)
    return met.mapInArrow(visit, "query_id long, vec_id long, score long")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, id_column: str = "vec_id",
          vector_column: str = "embedding", scale: int = 1024) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best other rows of every row of ``queries``."""
    return top_k_and_work(vectors, queries, k, id_column, vector_column, scale)[0]


def top_k_and_work(vectors: DataFrame, queries: DataFrame, k: int = 10, id_column: str = "vec_id",
                   vector_column: str = "embedding", scale: int = 1024) -> tuple[DataFrame, DataFrame]:
    """The result of ``top_k``, and one row of what it cost: products computed and possible, and rows given to the merge."""
    rows = usable(vectors, id_column, vector_column, scale)
    shards = written(in_blocks(rows, SHARD_ROWS, scale), "topk-shards")
    wanted = usable(queries, id_column, vector_column, scale).dropDuplicates(["vec_id", "values"])
    blocks = written(in_blocks(written(wanted, "topk-wanted"), QUERY_ROWS, scale), "topk-queries")
    asked = written(with_floors(blocks, shards, k), "topk-floors")
    runs = max(1, math.ceil(shards.count() / RUN_SHARDS))
    step = math.isqrt(runs)
    placed = shards.select("*", F.pmod(F.xxhash64("ids"), F.lit(runs)).alias("run"))
    found = written(visits(asked, placed, k, f"sequence(0L, {runs - 1}L, {step}L)"), "topk-found")
    if step > 1:
        raised = written(raised_floors(asked, found.where(F.col("query_id").isNotNull()), k), "topk-floors")
        others = written(visits(raised, placed, k, f"filter(sequence(0L, {runs - 1}L), run -> run % {step} <> 0)"), "topk-found")
        found = found.unionByName(others)
    hits = found.where(F.col("query_id").isNotNull())
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    result = hits.withColumn("rank", rank).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    cost = found.where(F.col("query_id").isNull()).agg(F.sum("vec_id").alias("products"), F.sum("score").alias("possible"))
    return result, cost.crossJoin(hits.agg(F.count("*").alias("merged")))


def _found(query_ids: np.ndarray, best: list[Best]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.array(np.repeat(query_ids, [len(b.ids) for b in best]), pa.int64()),
        pa.array([int(i) for b in best for i in b.ids], pa.int64()),
        pa.array([int(s) for b in best for s in b.scores], pa.int64()),
    ], schema=FOUND)
