import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from kinweave.llm import alignment
from rows import AWKWARD, CLASHING

PATH_A, PATH_B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(PATH_A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATH_B)


def tokens(libraries, text):
    """Ids and byte ranges of whole texts by both libraries; None where their bytes differ from the text's."""
    a, b = libraries
    if not text:
        return None
    alphabet = alignment.byte_alphabet()
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    bytes_a = [bytes(alphabet[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
        return None
    ranges = []
    for ids, parts in ((ids_a, bytes_a), (ids_b, bytes_b)):
        end, found = 0, []
        for i, part in zip(ids, parts):
            found.append((i, end, end + len(part)))
            end += len(part)
        ranges.append(found)
    return ranges


def plain(libraries, rows):
    """The contract, pair by pair, on whole texts."""
    docs = [(doc_id, tokens(libraries, text)) for doc_id, text in rows]
    links = []
    for _, found in docs:
        a, b = found or ([], [])
        links.append([(i, j) for i, begin, end in a for j, start, stop in b if begin < stop and start < end])
    count = Counter(pair for found in links for pair in found)
    best = Counter()
    for (_, j), n in count.items():
        best[j] = max(best[j], n)
    out = Counter()
    for (doc_id, found), own in zip(docs, links):
        a, b = found or ([], [])
        ends = sorted({end for *_, end in a} & {end for *_, end in b})
        groups, start = [], 0
        for end in ends:
            groups.append("|".join(",".join(str(i) for i, begin, stop in side if start <= begin and stop <= end) for side in (a, b)))
            start = end
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if found else ""
        out[doc_id, len(a), len(b), len(ends), len(own), sum(count[p] == best[p[1]] for p in own), sum(count[p] for p in own), digest] += 1
    return out


def random_texts(seed, n, most=60):
    rng = random.Random(seed)
    pieces = ["the ", "whether", " ", "  ", "\n", "\r\n", "\t", "é", "ß ", " ", " ", "　 ", "中文 ", "🙂", "\x85 ", "Ünder", "'s", "don't ",
              "1234", "...", "<|endoftext|>", "<s>", "\x00", "​ ", "x" * 30, "ing ", ". ", "\x1c ", "á ", "; ", "{\r\n", ".", ",", "a", "B.", "é,", ".,", "Dr"]
    return ["".join(rng.choice(pieces) for _ in range(rng.randint(1, most))) for _ in range(n)]


def test_parts_of_texts_give_the_tokens_of_whole_texts(libraries):
    texts = [*random_texts(1, 600), " a", "\na", "a \n b", "▁a", "a▁b c", " ", "\n", ""]
    rows = alignment.Aligner(PATH_A, PATH_B).align(pa.array(texts))
    for text, row in zip(texts, rows):
        found = tokens(libraries, text)
        assert row[:2] == ((len(found[0]), len(found[1])) if found else (0, 0)), text


@pytest.mark.parametrize("hot_pairs", [0, 40, alignment.HOT_PAIRS])
def test_documents_equal_pair_by_pair(spark, documents, libraries, hot_pairs):
    texts = random_texts(2, 60, 30)
    rows = [(n % 50, text) for n, text in enumerate(texts)] + [(7, texts[3])] * 20 + [(None, "a b"), (99, None), (98, ""), (97, "▁")]
    found = alignment.score_documents(documents([(*row, "en", "a", 1) for row in rows]).repartition(3), PATH_A, PATH_B, hot_pairs)
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert found.columns == columns
    assert Counter(map(tuple, found.collect())) == plain(libraries, rows)


def test_a_pair_in_predicted_and_other_groups_counts_once_for_all():
    v = alignment.load_vocabularies(PATH_A, PATH_B)
    some = np.flatnonzero(v.same >= 0)
    assert len(some) > 10_000 and all(v.a_bytes[i] == v.b_bytes[v.same[i]] for i in some[::97])


def test_awkward_rows_no_rows_and_clashing_names(documents, awkward, nothing, libraries):
    rows = [(row[0], row[1]) for row in AWKWARD if row[1] is None or len(row[1]) < 1000]
    df = documents([row for row in AWKWARD if row[1] is None or len(row[1]) < 1000], clashing=True)
    for name in ("same", "other", "n_a", "code", "n", "b", "rare"):
        df = df.withColumn(name, df["doc_id"])
    assert Counter(map(tuple, alignment.score_documents(df, PATH_A, PATH_B).collect())) == plain(libraries, rows)
    assert alignment.score_documents(nothing, PATH_A, PATH_B).collect() == []
    long = {row.doc_id: row for row in alignment.score_documents(awkward, PATH_A, PATH_B).collect()}
    assert long[5].n_a > 100_000 and long[9].n_links == long[9].n_a + long[9].n_b - long[9].n_groups
