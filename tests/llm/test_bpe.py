import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from kinweave.llm import bpe, tables
from rows import AWKWARD

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return bpe.load_codec(PATH, public_tokenizers.PATTERN)


def test_codec_agrees_with_the_library(codec, library):
    rng = random.Random(2)
    texts = ["", " ", "I'll don't <|endoftext|>", "=" * 3000, "a" * 4000, "  x  \n\n y"]
    texts += ["".join(rng.choice("ab1é漢🙂 \n\tTHE") for _ in range(rng.randint(1, 400))) for _ in range(200)]
    texts += ["".join(rng.choice("thaneiorsbl") for _ in range(n)) for n in (511, 512, 513, 2000)]
    for text, ids in zip(texts, codec.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()


def test_equal_ranks_merge_from_the_left():
    small = bpe.Codec([bytes([b]) for b in range(256)] + [b"aa", b"aaa"], r".+")
    assert [np.frombuffer(x, "<u4").tolist() for x in small.encode(["aaa", "aaaa", "aaaab"])] == [[257], [256, 256], [256, 256, 98]]
    assert small._merge_long(b"aaaab") == [256, 256, 98]


def test_a_full_cache_starts_anew(codec, monkeypatch, library):
    monkeypatch.setattr(bpe, "CACHED_PIECES", 1)
    for text in ("some words here", "other words there"):
        assert np.frombuffer(codec.encode([text])[0], "<u4").tolist() == library.encode_ordinary(text)


def test_caches_are_kept_apart_and_one_operator_s_at_a_time():
    first, second = tables.worker_cache("a", 1), tables.worker_cache("a", 2)
    first["x"] = 1
    assert tables.worker_cache("a", 1) is first and "x" not in second
    tables.worker_cache("b")
    assert not first


def test_a_gap_in_the_ranks_is_refused(tmp_path):
    (tmp_path / "ranks").write_text("YQ== 0\nYg== 2\n")
    with pytest.raises(ValueError, match="gaps"):
        bpe.load_codec(str(tmp_path / "ranks"), ".")


def test_documents(awkward, nothing, library):
    found = sorted(map(tuple, bpe.digest_documents(awkward, PATH, public_tokenizers.PATTERN).collect()), key=str)
    expected = []
    for doc_id, text, *_ in AWKWARD:
        ids = library.encode_ordinary(text or "")
        expected.append((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                         hashlib.sha256((text or "").encode()).hexdigest()))
    assert found == sorted(expected, key=str)
    assert bpe.digest_documents(nothing, PATH, public_tokenizers.PATTERN).collect() == []
    whole = bpe.encode_documents(awkward.where("doc_id = 4"), PATH, public_tokenizers.PATTERN).first()
    assert whole.decoded.decode() == AWKWARD[4][1] and len(whole.ids) == 4 * whole.n_tokens
