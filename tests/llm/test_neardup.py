import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kinweave.llm import neardup
from kinweave.llm.components import components
from rows import AWKWARD


def plain_sets(rows, words_each):
    found = {}
    for doc_id, text, *_ in rows:
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
        runs = [tuple(words[i:i + words_each]) for i in range(len(words) - words_each + 1)] or ([tuple(words)] if words else [])
        found.setdefault(doc_id, set()).add(frozenset(runs))
    return found


def plain_components(rows, words_each, percent):
    """Smallest linked id of every id, by comparing all pairs."""
    sets = {doc_id: own for doc_id, own in plain_sets(rows, words_each).items() if doc_id is not None}
    up = {doc_id: doc_id for doc_id in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for at, a in enumerate(ids):
        for b in ids[at + 1:]:
            if any(100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b] if x and y):
                low, high = sorted((root(a), root(b)))
                up[high] = low
    return {doc_id: root(doc_id) for doc_id in sets}


def random_corpus(seed, groups=25, length=60):
    """Groups of edited copies; some edits are heavy, so that chains and misses occur around the threshold."""
    rng, rows = random.Random(seed), []
    for _ in range(groups):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.randint(3, length))]
        for _ in range(rng.choice((1, 2, 3, 12))):
            words = list(base)
            for _ in range(rng.choice((0, 0, 1, 2, 3, 6))):
                words[rng.randrange(len(words))] = f"e{rng.randrange(50)}"
            rows.append((len(rows), " ".join(words), "en", "s", 0))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, words_each, block", [(1, 4, 256), (2, 5, 3)])
def test_components_equal_comparing_all_pairs(documents, monkeypatch, seed, words_each, block):
    monkeypatch.setattr(neardup, "BLOCK_NODES", block)
    rows = random_corpus(seed)
    found = {r.doc_id: r for r in neardup.find_components(documents(rows), words_each, 80).collect()}
    expected = plain_components(rows, words_each, 80)
    assert {doc_id: r.component_id for doc_id, r in found.items()} == expected
    assert all(r.kept == (r.component_id == doc_id) for doc_id, r in found.items())
    sizes = plain_sets(rows, words_each)
    assert all(r.n_shingles == len(*sizes[doc_id]) for doc_id, r in found.items())


def test_awkward_documents(awkward, nothing):
    found = neardup.find_components(awkward, 4, 80).collect()
    expected = plain_components(AWKWARD, 4, 80)
    assert len(found) == len(AWKWARD)
    for row in found:
        if row.doc_id is None:
            assert row.component_id is None and row.kept
        else:
            assert (row.component_id, row.kept) == (expected[row.doc_id], expected[row.doc_id] == row.doc_id)
    assert {r.doc_id: r.n_shingles for r in found if r.doc_id in (1, 2, 3)} == {1: 0, 2: 0, 3: 0}
    assert neardup.find_components(nothing).collect() == []
    assert neardup.keep_one_of_each(nothing).collect() == []


def test_one_of_each_stays_as_it_is(awkward, documents):
    kept = neardup.keep_one_of_each(awkward)
    assert kept.columns == awkward.columns
    ids = sorted(row.doc_id if row.doc_id is not None else -1 for row in kept.collect())
    assert ids == [-1, -1, 1, 2, 3, 4, 5, 6, 8, 9, 10]
    rows = random_corpus(3)
    stays = {row.doc_id for row in neardup.keep_one_of_each(documents(rows)).collect()}
    assert stays == set(plain_components(rows, 5, 80).values())


def plain_estimate(a, b):
    differs = np.bitwise_or.reduce((a ^ b).view(np.uint64).reshape(neardup.BITS, -1))
    return neardup._corrected(np.bitwise_count(differs).sum())


def test_estimates_follow_similarity(spark):
    rng = np.random.default_rng(1)
    for share in (0.3, 0.6, 0.8, 0.95):
        common, found = int(400 * share), []
        for _ in range(30):
            pool = rng.integers(0, 2 ** 63, 800 - common, dtype=np.uint64)
            half = (800 - 2 * common) // 2
            a, b = np.concatenate([pool[:common], pool[common:common + half]]), np.concatenate([pool[:common], pool[common + half:]])
            true = common / len(pool)
            found.append(plain_estimate(neardup.planes(neardup.minima(a)), neardup.planes(neardup.minima(b))) - true)
        assert abs(np.mean(found)) < 0.03 and max(map(abs, found)) < neardup.MARGIN


def test_the_estimate_column_equals_numpy(spark):
    rng = np.random.default_rng(2)
    a, b = (neardup.planes(neardup.minima(rng.integers(0, 2 ** 63, 50, dtype=np.uint64))) for _ in range(2))
    df = spark.createDataFrame([(a.tolist(), b.tolist())], "a array<long>, b array<long>")
    expected = plain_estimate(a, b)
    assert df.select(neardup.estimate(F.col("a"), F.col("b"))).first()[0] == pytest.approx(float(expected))


def test_minima_do_not_depend_on_the_chunking():
    hashes = np.random.default_rng(3).integers(0, 2 ** 63, 9000, dtype=np.uint64)
    assert (neardup.minima(hashes) == np.minimum(neardup.minima(hashes[:100]), neardup.minima(hashes[100:]))).all()


def test_components_of_chains_stars_and_loops(spark):
    edges = [(n, n + 1) for n in range(1, 200)] + [(1000, n) for n in range(1001, 1050)] + [(5000, 5000), (7001, 7000), (7000, 7001)]
    found = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert {found[n] for n in range(1, 201)} == {1} and {found[n] for n in range(1000, 1050)} == {1000}
    assert found[5000] == 5000 and found[7000] == found[7001] == 7000
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_block_pairs_hold_every_pair_once(spark):
    df = spark.range(50).selectExpr("id AS node", "1L AS family")
    rows = neardup.block_pairs(df, "family", F.lit(4)).collect()
    home = {r.node: r.block for r in rows}
    for a in range(50):
        for b in range(a):
            low, high = sorted((home[a], home[b]))
            both = {(r.lower, r.upper) for r in rows if r.node == a} & {(r.lower, r.upper) for r in rows if r.node == b}
            assert (low, high) in both


def test_a_block_gives_no_more_links_than_join_it():
    hashes = np.arange(100, dtype=np.uint64).tobytes()
    table = pa.table({"family": [1] * 40, "lower": [0] * 40, "upper": [0] * 40, "block": [0] * 40,
                      "node": list(range(40)), "hashes": [hashes] * 40})
    assert len(neardup._confirmed_links(table, 80)[0]) == 39


def test_one_id_with_several_texts_links_them(documents):
    rng = random.Random(4)
    base = [[f"b{k}w{rng.randrange(10 ** 6)}" for _ in range(60)] for k in range(3)]

    def copy(k, at):
        return " ".join(base[k][:at] + ["other"] + base[k][at + 1:])

    texts = [(1, " ".join(base[0])), (1, " ".join(base[1])), (1, ""), (2, copy(0, 0)), (3, copy(1, 59)), (4, copy(2, 0)),
             (5, " ".join(base[2])), (5, ""), (5, copy(1, 0)), (6, "quite something else than all of these")]
    rows = [(doc_id, text, "en", "s", 0) for doc_id, text in texts]
    expected = plain_components(rows, 5, 80)
    assert expected == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 6: 6}
    found = neardup.find_components(documents(rows), 5, 80).collect()
    assert len(found) == len(rows) and all(r.component_id == expected[r.doc_id] for r in found)


def test_a_block_has_one_row_of_each_set(documents, monkeypatch):
    """A block of more rows than BLOCK_NODES * 2 would be noticed here by its size."""
    seen = neardup.block_pairs
    tables = []

    def noted(rows, group, n_blocks):
        if "hashes" in rows.columns:
            tables.append(rows.count())
        return seen(rows, group, n_blocks)

    monkeypatch.setattr(neardup, "block_pairs", noted)
    words = [f"w{n}" for n in range(60)]
    rows = [(1, " ".join(words), "en", "s", 0)] * 500 + [(2, " ".join(["other", *words[1:]]), "en", "s", 0)]
    found = neardup.find_components(documents(rows), 5, 80).collect()
    assert tables == [2] and {r.component_id for r in found} == {1}
