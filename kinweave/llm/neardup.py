"""Near-duplicate documents by b-bit MinHash, with links confirmed on full shingle sets.

1. Every text becomes its set of word shingles (64-bit hashes), KEPT minima of it, their low BITS as
   bit planes in 64-bit words, and band keys of the full minima. Documents with equal sets are one
   node, named by a 64-bit digest of the set, however many ids and rows it has.
2. Nodes that share a band key are candidates. Each is held against the bucket's smallest and largest
   node by the bit counts of the planes, corrected for chance collisions; estimates of the
   threshold less MARGIN (about four standard deviations) make families.
3. Buckets that still hold several families are compared in blocks, by bit counts, until every pair
   of a bucket with a sufficient estimate lies in one family. A block gives only the links that
   join families.
4. Within a family all pairs are confirmed on full sets, in blocks again: families are split into
   blocks of bounded size, every pair of blocks is one group, and a group gives only the links
   that join its parts. Links between the sets of one doc_id are added. The components are the
   result, each named by its smallest doc_id.

No group holds more than two blocks and no step lists all pairs of a group. Two sets at the
threshold share no band with a probability of (1 - t^ROWS)^BANDS, 3e-6 at 0.8.

Defined cases: null and empty texts have no shingle, stand alone and are kept; fewer words than a
shingle make one shingle of the whole sequence. Rows without an id take no part: component null,
kept. Repeated rows are copies. Different texts under one id count as linked, being one document.
Whole texts are read; columns other than doc_id and text are not. An empty table gives an empty result.
"""

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from kinweave.llm.components import components
from kinweave.llm.tables import as_bytes, map_texts, ship_package, worker_cache, written

WORDS = 5
PERCENT = 80
BANDS, ROWS = 32, 5
KEPT, BITS = 192, 4
MARGIN = 0.14
PLANE = KEPT // 64
BLOCK_NODES, BLOCK_SHINGLES = 256, 1 << 17
CACHED_WORDS = 200_000
PRIME = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes, words_each: int) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a UTF-8 text's word shingles; A-Z count as lower case."""
    import xxhash

    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < words_each:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    known = worker_cache("words")
    if len(known) > CACHED_WORDS:
        known.clear()
    for word in set(words).difference(known):
        known[word] = xxhash.xxh3_64_intdigest(word)
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    n = len(words) - words_each + 1
    state = np.zeros(n, np.uint64)
    for k in range(words_each):
        state = state * PRIME + hashes[k:k + n]
    return np.unique(_mix(state))


@lru_cache(maxsize=1)
def _permutations() -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(5)
    return (random.integers(0, 2 ** 63, KEPT, dtype=np.uint64) << np.uint64(1) | np.uint64(1),
            random.integers(0, 2 ** 63, KEPT, dtype=np.uint64))


def minima(hashes: np.ndarray) -> np.ndarray:
    factor, shift = _permutations()
    lowest = np.full(KEPT, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 2048):
        np.minimum(lowest, (hashes[at:at + 2048, None] * factor + shift).min(axis=0), out=lowest)
    return lowest >> np.uint64(24)


def planes(lowest: np.ndarray) -> np.ndarray:
    """The low BITS of the minima: BITS planes of KEPT bits, as 64-bit words."""
    bits = (lowest[None, :] >> np.arange(BITS, dtype=np.uint64)[:, None]) & np.uint64(1)
    return np.packbits(bits.astype(np.uint8), axis=1, bitorder="little").view("<i8").ravel()


def band_keys(lowest: np.ndarray) -> np.ndarray:
    state = np.arange(BANDS, dtype=np.uint64)
    for column in lowest[:BANDS * ROWS].reshape(BANDS, ROWS).T:
        state = _mix(state * PRIME + column)
    return state.view(np.int64)


def estimate(a: Column, b: Column) -> Column:
    """Similarity of two plane arrays: the share of equal low bits less what chance makes equal."""
    def differing(word):
        parts = [a[plane * PLANE + word].bitwiseXOR(b[plane * PLANE + word]) for plane in range(BITS)]
        differs = parts[0]
        for part in parts[1:]:
            differs = differs.bitwiseOR(part)
        return F.bit_count(differs)

    mismatches = sum((differing(word) for word in range(1, PLANE)), differing(0))
    return _corrected(mismatches)


def _corrected(mismatches):
    return (1 - mismatches / KEPT - 2.0 ** -BITS) / (1 - 2.0 ** -BITS)


def digest(found: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(found.tobytes(), digest_size=8).digest(), "little", signed=True)


def signatures(documents: DataFrame, words_each: int) -> DataFrame:
    """doc_id, n_shingles, node (digest of the set), planes, bands; the last three null without shingles."""
    def start():
        def handle(batch):
            rows = []
            for text in as_bytes(batch["text"]):
                found = shingles(text, words_each)
                if len(found):
                    lowest = minima(found)
                    rows.append((len(found), digest(found), planes(lowest), band_keys(lowest)))
                else:
                    rows.append((0, None, None, None))
            longs = pa.list_(pa.int64())
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), longs, longs))]
            return pa.RecordBatch.from_arrays([batch["doc_id"], *columns], ["doc_id", "n_shingles", "node", "planes", "bands"])
        return handle

    return map_texts(documents.select(F.col("doc_id").cast("long"), "text"),
                     "doc_id long, n_shingles long, node long, planes array<long>, bands array<long>", start, cache="words")


def find_components(documents: DataFrame, words_each: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document: linked at 100 * shared >= percent * united."""
    signed = written(signatures(documents, words_each), "minhash")
    whole = signed.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    nodes = written(whole.groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("planes").alias("planes"),
        F.first("bands").alias("bands")), "minhash-nodes")
    families = find_families(nodes, percent)
    links = confirm(documents, nodes, families, words_each, percent)
    # the sets of one id are linked, as they are one document
    of_id = written(whole.groupBy("doc_id").agg(F.min("node").alias("node"), F.max("node").alias("last")), "near-ids")
    several = of_id.where(F.col("node") != F.col("last")).select("doc_id", F.col("node").alias("a"))
    own = whole.select("doc_id", F.col("node").alias("b")).join(several, "doc_id").where(F.col("a") != F.col("b"))
    linked = components(links.unionByName(own.select("a", "b").distinct()), "links")
    linked = written(nodes.select("node", "doc_id").join(linked, "node", "left").select(
        "node", "doc_id", F.coalesce("component", "node").alias("part")), "near-components")
    named = linked.groupBy("part").agg(F.min("doc_id").alias("component"))
    component = linked.join(named, "part").select("node", "component")
    component = of_id.select("doc_id", "node").join(component, "node").select("doc_id", "component")
    return signed.select("doc_id", "n_shingles").join(component, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce("component", "doc_id").eqNullSafe(F.col("doc_id")).alias("kept"))


def find_families(nodes: DataFrame, percent: int) -> DataFrame:
    """(node, family, n) of the nodes that may have a link; every linked pair that shares a bucket is in one family."""
    least = percent / 100 - MARGIN
    buckets = nodes.select("node", F.explode("bands").alias("band"))
    # both sides of the joins on a band are plain shuffles, so that a hot band can be split
    ends = buckets.groupBy("band").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.count("*").alias("size"))
    ends = written(ends.where(F.col("low") < F.col("high")), "minhash-ends")
    members = written(buckets.join(ends, "band"), "minhash-buckets")

    stars = members.select("node", F.explode(F.array("low", "high")).alias("leader")).where(F.col("node") != F.col("leader"))
    stars = stars.select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct()
    # a written table, so that a hot leader's share of the joins below can be split
    signature = written(nodes.select("node", "n", "planes"), "minhash-planes")

    def side(name):
        return signature.select(F.col("node").alias(name), F.col("n").alias(f"n_{name}"), F.col("planes").alias(f"p_{name}"))

    near = stars.join(side("a"), "a").join(side("b"), "b").where(
        (100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")) & (estimate(F.col("p_a"), F.col("p_b")) >= least))
    near = written(near.select("a", "b"), "minhash-stars")
    first = written(components(near, "stars").select("node", F.col("component").alias("family")), "minhash-families")

    named = members.select("band", "size", "node").join(first, "node", "left").select(
        "band", "size", "node", F.coalesce("family", "node").alias("family"))
    named = written(named, "minhash-named")
    mixed = named.groupBy("band").agg(F.min("family").alias("low"), F.max("family").alias("high"))
    open_ = named.join(written(mixed.where(F.col("low") < F.col("high")).select("band"), "minhash-mixed"), "band")
    blocks = block_pairs(open_.join(signature, "node"), "band", F.ceil(F.col("size") / BLOCK_NODES))

    def join_families(table: pa.Table) -> pa.Table:
        return _links_table(*_estimated_links(table, percent, least))

    ship_package(nodes.sparkSession)
    more = blocks.groupBy("band", "lower", "upper").applyInArrow(join_families, "a long, b long")
    joined = written(more.distinct(), "minhash-joins")
    merged = components(joined, "families")
    # a family that only now is joined is a node of its own name; of a node's two names the smaller is its family's
    named_now = joined.select(F.explode(F.array("a", "b")).alias("node")).select("node", F.col("node").alias("family"))
    families = first.unionByName(named_now).groupBy("node").agg(F.min("family").alias("family"))
    renamed = merged.select(F.col("node").alias("family"), "component")
    families = families.join(renamed, "family", "left").select("node", F.coalesce("component", "family").alias("family"))
    return written(families.join(signature.select("node", "n"), "node"), "minhash-all-families")


def block_pairs(rows: DataFrame, group: str, n_blocks: Column) -> DataFrame:
    """Each row once for every pair of blocks of its group that holds its own block: columns lower, upper, block.

    A group's blocks are picked by a hash of the node. Rows of a pair (lower = upper) are compared
    with each other, those of two blocks across.
    """
    placed = rows.withColumn("blocks", n_blocks.cast("int"))
    placed = placed.withColumn("block", F.pmod(F.xxhash64("node", group), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    spread = placed.select("*", other)
    return spread.withColumns({"lower": F.least("block", "other"), "upper": F.greatest("block", "other")}).drop("other", "blocks")


class Sets:
    """Disjoint sets of places 0..n-1."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def unite(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def _links_table(a: list[int], b: list[int]) -> pa.Table:
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _sides(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Places of the rows of the lower and of the upper block."""
    block = np.asarray(table["block"])
    return (np.flatnonzero(block == table["lower"][0].as_py()), np.flatnonzero(block == table["upper"][0].as_py()))


def _estimated_links(table: pa.Table, percent: int, least: float) -> tuple[list[int], list[int]]:
    """Pairs of families that a sufficient estimate joins, as few as join them all."""
    lower, upper = _sides(table)
    family, n = np.asarray(table["family"]), np.asarray(table["n"])
    words = np.asarray(table["planes"].combine_chunks().flatten()).view(np.uint64).reshape(-1, BITS, PLANE)
    names, place = np.unique(family, return_inverse=True)
    sets, a, b = Sets(len(names)), [], []
    for x in lower:
        others = upper[(family[upper] != family[x]) & (100 * np.minimum(n[upper], n[x]) >= percent * np.maximum(n[upper], n[x]))]
        if not len(others):
            continue
        differs = np.bitwise_or.reduce(words[others] ^ words[x], axis=1)
        alike = _corrected(np.bitwise_count(differs).sum(axis=1)) >= least
        for y in np.unique(place[others[alike]]):
            if sets.unite(int(place[x]), int(y)):
                a.append(int(family[x]))
                b.append(int(names[y]))
    return a, b


def confirm(documents: DataFrame, nodes: DataFrame, families: DataFrame, words_each: int, percent: int) -> DataFrame:
    """Links (a, b) between nodes, confirmed on full sets: within each pair of blocks enough to join all that is linked."""
    sizes = families.groupBy("family").agg(F.count("*").alias("members"), F.sum("n").alias("volume"))
    n_blocks = F.greatest(F.ceil(F.col("members") / BLOCK_NODES), F.ceil(F.col("volume") / BLOCK_SHINGLES))
    sizes = sizes.where("members > 1").select("family", n_blocks.alias("n_blocks"))
    chosen = written(families.join(sizes, "family").select("node", "family", "n_blocks"), "near-chosen")
    ids = chosen.join(nodes.select("node", "doc_id"), "node").select("doc_id").distinct()
    # the chosen ids grow with the data, so they are never broadcast
    texts = documents.select(F.col("doc_id").cast("long"), "text").join(ids.hint("merge"), "doc_id").select("text")

    def start():
        def handle(batch):
            # a text without words has no node; the join with the chosen drops it
            found = [shingles(text, words_each) for text in as_bytes(batch["text"])]
            return pa.RecordBatch.from_arrays(
                [pa.array([digest(own) if len(own) else None for own in found], pa.int64()),
                 pa.array([own.tobytes() for own in found], pa.binary())], ["node", "hashes"])
        return handle

    # one row of each set before the blocks, however often its ids are repeated
    sets = map_texts(texts, "node long, hashes binary", start, cache="words").where(F.col("node").isNotNull())
    full = sets.groupBy("node").agg(F.first("hashes").alias("hashes")).join(chosen.hint("merge"), "node")
    blocks = block_pairs(full, "family", F.col("n_blocks")).select("family", "lower", "upper", "block", "node", "hashes")

    def link(table: pa.Table) -> pa.Table:
        return _links_table(*_confirmed_links(table, percent))

    return written(blocks.groupBy("family", "lower", "upper").applyInArrow(link, "a long, b long"), "near-links")


def _confirmed_links(table: pa.Table, percent: int) -> tuple[list[int], list[int]]:
    lower, upper = _sides(table)
    node = np.asarray(table["node"])
    rows = [np.frombuffer(value, np.uint64) for value in table["hashes"].to_pylist()]
    sizes = np.array([len(row) for row in rows])
    _, coded = np.unique(np.concatenate(rows), return_inverse=True)
    ends = np.cumsum(sizes)
    coded = [coded[end - size:end] for end, size in zip(ends, sizes)]
    there = np.zeros(int(max(c.max(initial=-1) for c in coded)) + 1, bool)
    sets, a, b = Sets(len(rows)), [], []
    for x in lower.tolist():
        others = upper[100 * np.minimum(sizes[upper], sizes[x]) >= percent * np.maximum(sizes[upper], sizes[x])]
        root = sets.root(x)
        others = np.array([y for y in others.tolist() if y != x and sizes[y] and sets.root(y) != root], np.int64)
        if not len(others) or not sizes[x]:
            continue
        there[coded[x]] = True
        joined = np.concatenate([coded[y] for y in others])
        shared = np.add.reduceat(there[joined].astype(np.int64), np.cumsum(sizes[others]) - sizes[others])
        there[coded[x]] = False
        linked = 100 * shared >= percent * (sizes[x] + sizes[others] - shared)
        for y in others[linked].tolist():
            if sets.unite(x, y):
                a.append(int(node[x]))
                b.append(int(node[y]))
    return a, b


def keep_one_of_each(documents: DataFrame, words_each: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One document of each group of near duplicates, as it is. Of repeated rows one stays; rows without an id all stay."""
    found = find_components(documents, words_each, percent).where(F.col("doc_id").isNotNull())
    verdict = found.groupBy(F.col("doc_id").alias("judged_id")).agg(
        F.max("kept").alias("stays"), F.count("*").alias("times")).where(~F.col("stays") | (F.col("times") > 1))
    verdict = written(verdict, "near-verdict")
    rows = documents.select(F.col("doc_id").cast("long").alias("judged_id"), F.col("text").alias("judged_text"),
                            F.struct(*documents.columns).alias("row"))
    once = rows.join(verdict, "judged_id", "left_anti")
    repeated = rows.join(verdict.where("stays").select("judged_id"), "judged_id")
    return once.unionByName(repeated.dropDuplicates(["judged_id", "judged_text"])).select("row.*")
