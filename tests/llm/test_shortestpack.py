import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from kinweave.llm import shortestpack
from kinweave.llm.shortestpack import make_plan, shortest_pack_first
from rows import AWKWARD, CLASHING

PATH = public_tokenizers.path("word_bpe_49k.json")


def one_at_a_time(histogram, capacity):
    """Every length by itself, longest first, into the pack with the most room; the multiset of packs."""
    packs = []
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            best = min(range(len(packs)), key=lambda at: sum(packs[at]), default=None)
            if best is None or sum(packs[best]) + length > capacity:
                packs.append([])
                best = len(packs) - 1
            packs[best].append(length)
    return Counter(sum(pack) for pack in packs), len(packs)


HISTOGRAMS = [
    {}, {1: 1}, {1: 5000}, {64: 3}, {63: 7, 1: 3}, {30: 5, 20: 9, 3: 100}, {33: 10, 31: 10}, {34: 12, 15: 40, 2: 7},
    *[dict(Counter(random.Random(seed).randint(1, 63) for _ in range(300))) for seed in range(5)],
    *[dict(Counter(min(63, 1 + int(random.Random(seed).expovariate(0.1) * (i % 7 + 1))) for i in range(500))) for seed in range(5)],
]


@pytest.mark.parametrize("histogram", HISTOGRAMS)
def test_patterns_hold_every_length_as_if_placed_one_by_one(histogram):
    patterns = shortest_pack_first(histogram, 64)
    held = Counter()
    for pattern in patterns:
        assert pattern.used == sum(length * times for length, times in pattern.holds) <= 64
        assert [length for length, _ in pattern.holds] == sorted({length for length, _ in pattern.holds}, reverse=True)
        for length, times in pattern.holds:
            held[length] += pattern.count * times
    assert held == Counter(histogram)
    used, n = one_at_a_time(histogram, 64)
    assert sum(pattern.count for pattern in patterns) == n
    assert sum((Counter({p.used: p.count}) for p in patterns), Counter()) == used


@pytest.mark.parametrize("least_gap", [1, 4, 64])
@pytest.mark.parametrize("histogram", HISTOGRAMS)
def test_plan_fills_sequences_without_gaps_between_parts(histogram, least_gap):
    patterns = shortest_pack_first(histogram, 64)
    plan = make_plan(patterns, 64, least_gap)
    sequences = defaultdict(list)
    for length, n in histogram.items():
        for rank in range(n):
            at = np.searchsorted(plan.key, (length << shortestpack.RANK_BITS) + rank, "right") - 1
            inside = rank - int(plan.key[at] & (1 << shortestpack.RANK_BITS) - 1)
            if plan.streamed[at]:
                parts = plan.cut(int(plan.first[at]) + inside * length, length)
                assert sum(size for _, size, _, _ in parts) == length
                for _, size, sequence, offset in parts:
                    sequences[sequence].append((offset, size))
            else:
                number, copy = divmod(inside, int(plan.times[at]))
                sequences[int(plan.first[at]) + number].append((int(plan.offset[at]) + copy * length, length))
    filled = []
    for parts in sequences.values():
        end = 0
        for offset, size in sorted(parts):
            assert offset == end
            end += size
        filled.append(end)
    assert all(0 < end <= 64 for end in filled) and sum(filled) == sum(l * n for l, n in histogram.items())
    padded = [64 - end for end in filled if end.bit_count() != 1]
    assert all(gap < least_gap for gap in padded)


def whole(found, documents):
    """Checks every piece against the library's ids and returns the sequences' lengths."""
    library = Tokenizer.from_file(PATH)
    expected = Counter()
    for doc_id, text in documents:
        expected[doc_id, np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4").tobytes()] += 1
    rows = [row.asDict() for row in found.collect()]
    sequences = defaultdict(list)
    for row in rows:
        sequences[row["sequence_id"]].append((row["offset"], row["length"]))
    filled = {}
    for sequence, parts in sequences.items():
        end = 0
        for offset, size in sorted(parts):
            assert offset == end and size > 0
            end += size
        filled[sequence] = end
    # a document's digests and places, as a multiset over repeated rows
    pieces = Counter((r["doc_id"], r["doc_tokens"], r["start"], r["length"], r["ids_crc32"]) for r in rows)
    by_doc = defaultdict(list)
    for (doc_id, tokens, start, length, digest), n in pieces.items():
        by_doc[doc_id, tokens].append((start, length, digest, n))
    for (doc_id, ids), n in expected.items():
        for start, length, digest, _ in by_doc[doc_id, len(ids) // 4]:
            if sum(1 for other in expected if other[0] == doc_id) == 1:
                assert zlib.crc32(ids[4 * start:4 * (start + length)]) == digest
    covered, wanted = Counter(), Counter()
    for (doc_id, tokens, start, length, _), n in pieces.items():
        for at in range(start, start + length):
            covered[doc_id, tokens, at] += n
    for (doc_id, ids), n in expected.items():
        for at in range(len(ids) // 4):
            wanted[doc_id, len(ids) // 4, at] += n
    assert covered == wanted
    return filled


def test_documents_are_whole_and_nothing_is_padded(spark, documents, awkward):
    filled = whole(shortestpack.pack_documents(awkward.repartition(3), PATH), [(row[0], row[1]) for row in AWKWARD])
    assert all(end == 4096 or end.bit_count() == 1 for end in filled.values())


def test_small_capacity_repeated_rows_and_few_cuts(documents):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(["one", "two", "word", "sequence"]) for _ in range(rng.randint(0, 40))), "en", "a", 1) for i in range(400)]
    rows += [(7, "the same text twice over", "en", "a", 1)] * 150
    found = shortestpack.pack_documents(documents(rows).repartition(5), PATH, capacity=64)
    filled = whole(found, [(row[0], row[1]) for row in rows])
    assert all(end <= 64 for end in filled.values())
    assert all(end == 64 or end.bit_count() == 1 for end in filled.values())
    assert found.where("length < doc_tokens").select("doc_id", "doc_tokens").distinct().count() < 40


def test_gaps_below_the_least_stay(documents):
    rows = [(i, "one two three", "en", "a", 1) for i in range(50)]
    found = shortestpack.pack_documents(documents(rows), PATH, capacity=14, least_gap=3)
    filled = whole(found, [(row[0], row[1]) for row in rows])
    assert Counter(filled.values())[12] > 10 and found.where("length < doc_tokens").count() <= 4


def test_no_documents_and_clashing_names(nothing, documents):
    assert shortestpack.pack_documents(nothing, PATH).collect() == []
    names = dict.fromkeys((*CLASHING, "task", "nth", "rest", "ids", "stream", "doc_tokens", "digests", "before", "offset", "n"), 1)
    df = documents([(1, "a b c", "en", "a", 1)])
    for name in names:
        df = df.withColumn(name, df["doc_id"])
    rows = shortestpack.pack_documents(df, PATH).collect()
    assert sum(row.length for row in rows) == 4 and {row.doc_tokens for row in rows} == {4}
