import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from kinweave.llm import packing
from rows import AWKWARD

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def test_words_in_runs_give_the_ids_of_whole_texts(library):
    rng = random.Random(3)
    texts = ["á b, c. d\u0085f\x1cg", "<|endoftext|> x", "a<|startoftext|>B <|ENDOFTEXT|>\n<|endoftext|><|endoftext|>", "<|StartOfText|>", "İstanbul ΣΑΣ ΣΑΣ.", "don't we'll 's", "\n\n \t x\ty", "́a ́", "a.. b,. .,", "Ünï CŒUR Ǆ ß."]
    texts += ["".join(rng.choice([*"abTé1,. \n'ß中", "<|endoftext|>"]) for _ in range(rng.randint(0, 300))) for _ in range(200)]
    for text, ids in zip(texts, packing.load_encoder(PATH).encode(pa.array([*texts]))):
        assert np.frombuffer(ids, "<u4").tolist() == library(text)


@pytest.mark.parametrize("sizes", [
    lambda rng: rng.randint(1, 100), lambda rng: rng.randint(20, 50), lambda rng: rng.choice((34, 51, 17, 33)), lambda rng: 40,
])
def test_packing_is_whole_and_no_worse_than_best_fit(sizes):
    rng = random.Random(4)
    for n in (0, 1, 2, 60, 400):
        lengths = [sizes(rng) for _ in range(n)]
        bins = packing.pack(lengths, 100)
        assert sorted(at for members in bins for at in members) == list(range(n))
        assert all(sum(lengths[at] for at in members) <= 100 for members in bins)
        bound = packing.lower_bound(Counter(lengths), 100) if n else 0
        assert bound <= len(bins) <= len(packing.best_fit(Counter(lengths), 100))


def exhaustive(lengths, capacity):
    """The least number of bins, by trying every bin for every piece."""
    best = [len(lengths)]

    def place(at, rooms):
        if len(rooms) >= best[0]:
            return
        if at == len(lengths):
            best[0] = len(rooms)
            return
        for number in range(len(rooms)):
            if rooms[number] >= lengths[at]:
                place(at + 1, [room - lengths[at] * (number == other) for other, room in enumerate(rooms)])
        place(at + 1, [*rooms, capacity - lengths[at]])

    place(0, [])
    return best[0]


def test_small_cases_are_optimal_or_next_to_it_and_the_bound_holds():
    rng, worse = random.Random(5), 0
    for _ in range(60):
        lengths = sorted((rng.randint(10, 70) for _ in range(9)), reverse=True)
        least = exhaustive(lengths, 100)
        assert packing.lower_bound(Counter(lengths), 100) <= least
        found = len(packing.pack(lengths, 100))
        assert found <= least + 1
        worse += found > least
    assert worse <= 3


def test_completion_beats_best_fit_where_it_can():
    # best fit decreasing needs 4 bins; 3 are enough
    lengths = [54, 41, 40, 39, 34, 30, 29, 17, 11]
    assert len(packing.best_fit(Counter(lengths), 100)) == 4
    assert len(packing.pack(lengths, 100)) == 3


def check_layout(rows, capacity):
    placed = {}
    for row in rows:
        placed.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for spans in placed.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= capacity
    return placed


def test_documents(awkward, nothing, library):
    rows = packing.pack_documents(awkward, PATH, shard_pieces=4).collect()
    check_layout(rows, 4096)
    expected = []
    for doc_id, text, *_ in AWKWARD:
        ids = [*library(text or ""), 1]
        for piece, at in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[at:at + 4096], "<u4")
            expected.append((doc_id, piece, at, len(part), zlib.crc32(part.tobytes())))
    assert sorted(map(str, expected)) == sorted(str(tuple(row)[:5]) for row in rows)
    assert packing.pack_documents(nothing, PATH).collect() == []


def test_full_pieces_stand_alone_and_equal_lengths_pack(documents):
    rows = packing.pack_documents(documents([(i, "the " * 2047, "en", "s", 1) for i in range(10)] +
                                            [(99, "the " * 4095, "en", "s", 1)]), PATH).collect()
    placed = check_layout(rows, 4096)
    assert sorted(len(spans) for spans in placed.values()) == [1, 2, 2, 2, 2, 2]
