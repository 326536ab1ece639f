"""Byte-level BPE encoding and decoding with a vocabulary of ranks.

Distinct pieces of a batch are laid out as rows of padded numpy matrices, one matrix per
length bucket. In each round every row merges its leftmost pair of minimum rank, which is
found by a hashed look-up of (left id, right id); a row without a pair is done and leaves
the matrix. Every row that stays loses one cell a round, so compaction keeps it rectangular.

Pieces longer than MATRIX_BYTES would need as many rounds as they have bytes; they take the
same merges from a heap over a linked list.

Defined cases: null text is empty and gives no ids; decoding gives the text's own bytes back.
Each row stands for itself, so copies, ties and empty tables need nothing special, and further
columns of the input are not read.
"""

import base64
import hashlib
import heapq
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from kinweave.llm.tables import as_texts, map_texts, worker_cache

MATRIX_BYTES = 512
MATRIX_CELLS = 1 << 20
CACHED_PIECES = 500_000
NONE = np.iinfo(np.int32).max
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
SPREAD = np.uint64(0x9E3779B97F4A7C15)


class PairTable:
    """Open-addressing hash table from (left id, right id) to the merged id."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        self.bits = max(4, int(2 * len(left)).bit_length() + 1)
        self.keys = np.full(1 << self.bits, EMPTY, np.uint64)
        self.values = np.full(1 << self.bits, NONE, np.int32)
        key = self._key(left, right)
        slot, waiting = self._slot(key), np.arange(len(key))
        while len(waiting):
            free = self.keys[slot[waiting]] == EMPTY
            _, first = np.unique(slot[waiting], return_index=True)
            placed = waiting[first[free[first]]]
            self.keys[slot[placed]] = key[placed]
            self.values[slot[placed]] = merged[placed]
            waiting = waiting[self.keys[slot[waiting]] != key[waiting]]
            slot[waiting] = (slot[waiting] + 1) & (len(self.keys) - 1)

    def _key(self, left, right):
        return (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)

    def _slot(self, key):
        return ((key * SPREAD) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged ids, NONE where a pair does not merge. A negative id is padding and never merges."""
        found = np.full(len(left), NONE, np.int32)
        open_ = np.flatnonzero((left >= 0) & (right >= 0))
        key = self._key(left[open_], right[open_])
        slot = self._slot(key)
        while len(open_):
            there = self.keys[slot]
            hit = there == key
            found[open_[hit]] = self.values[slot[hit]]
            on = ~hit & (there != EMPTY)
            open_, key, slot = open_[on], key[on], (slot[on] + 1) & (len(self.keys) - 1)
        return found


class Codec:
    """Encoder and decoder of one vocabulary; ``vocab[id]`` is a token's bytes, and its id is its rank."""

    def __init__(self, vocab: list[bytes], pattern: str, known: dict[str, bytes] | None = None):
        self.vocab = vocab
        self.known = {} if known is None else known  # the ids of pieces seen before, with this vocabulary
        self.ids = {token: i for i, token in enumerate(vocab)}
        self.single = np.array([self.ids[bytes([b])] for b in range(256)], np.int32)
        self.pieces_of = regex.compile(pattern).findall
        pairs = [
            (self.ids[token[:cut]], self.ids[token[cut:]], i)
            for i, token in enumerate(vocab) for cut in range(1, len(token))
            if token[:cut] in self.ids and token[cut:] in self.ids
        ]
        left, right, merged = (np.array(x, np.int64) for x in (zip(*pairs) if pairs else ((), (), ())))
        self.pairs = PairTable(left, right, merged.astype(np.int32))

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        split = [self.pieces_of(text) for text in texts]
        if len(self.known) > CACHED_PIECES:
            self.known.clear()
        new = {piece for pieces in split for piece in pieces}.difference(self.known)
        self.known.update(self._encode_pieces(new))
        known = self.known.__getitem__
        return [b"".join(map(known, pieces)) for pieces in split]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.vocab.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def _encode_pieces(self, pieces: set[str]):
        buckets: dict[int, list[tuple[str, bytes]]] = {}
        for piece in pieces:
            data = piece.encode()
            whole = self.ids.get(data)
            if whole is not None:
                yield piece, whole.to_bytes(4, "little")
            elif len(data) > MATRIX_BYTES:
                yield piece, np.array(self._merge_long(data), "<u4").tobytes()
            else:
                buckets.setdefault((len(data) - 1).bit_length(), []).append((piece, data))
        for power, members in buckets.items():
            step = MATRIX_CELLS >> power
            for at in range(0, len(members), step):
                yield from self._merge_rows(members[at:at + step], 1 << power)

    def _merge_rows(self, members: list[tuple[str, bytes]], width: int):
        lengths = np.array([len(data) for _, data in members])
        cells = np.full((len(members), width), -1, np.int32)
        cells[np.arange(width) < lengths[:, None]] = self.single[
            np.frombuffer(b"".join(data for _, data in members), np.uint8)
        ]
        names = np.arange(len(members))
        merges = self.pairs.find(cells[:, :-1].ravel(), cells[:, 1:].ravel()).reshape(len(members), width - 1)
        while len(names):
            # ids are ranks, and argmin takes the first of equal ones: the leftmost
            at = merges.argmin(axis=1) if merges.shape[1] else np.zeros(len(names), np.int64)
            best = merges[np.arange(len(names)), at] if merges.shape[1] else np.full(len(names), NONE)
            done = best == NONE
            for row, name in zip(cells[done], names[done]):
                yield members[name][0], row[row >= 0].astype("<u4").tobytes()
            cells, merges, names, at, best = cells[~done], merges[~done], names[~done], at[~done], best[~done]
            if not len(names):
                return
            rows = np.arange(len(names))
            cells[rows, at] = best
            cells = self._without(cells, rows, at + 1)
            merges = self._without(merges, rows, at)
            for spot in (at - 1, at):
                inside = rows[(spot >= 0) & (spot < merges.shape[1])]
                place = spot[inside]
                merges[inside, place] = self.pairs.find(cells[inside, place], cells[inside, place + 1])

    @staticmethod
    def _without(matrix, rows, column):
        keep = np.ones(matrix.shape, bool)
        keep[rows, column] = False
        return matrix[keep].reshape(len(rows), matrix.shape[1] - 1)

    def _merge_long(self, data: bytes) -> list[int]:
        """The same merges for one long piece: the heap gives the leftmost pair of minimum rank."""
        ids = self.single[np.frombuffer(data, np.uint8)].tolist()
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        merged = self.pairs.find(np.array(ids[:-1]), np.array(ids[1:])).tolist()
        heap = [(rank, at) for at, rank in enumerate(merged) if rank != NONE]
        heapq.heapify(heap)
        merged.append(NONE)

        def renew(at):
            right = after[at]
            merged[at] = NONE if right >= len(ids) else int(
                self.pairs.find(np.array([ids[at]]), np.array([ids[right]]))[0])
            if merged[at] != NONE:
                heapq.heappush(heap, (merged[at], at))

        while heap:
            rank, at = heapq.heappop(heap)
            if ids[at] < 0 or merged[at] != rank:
                continue
            gone = after[at]
            ids[at], ids[gone], merged[gone] = rank, -1, NONE
            after[at] = after[gone]
            if after[at] < len(ids):
                before[after[at]] = at
            renew(at)
            if before[at] >= 0:
                renew(before[at])
        return [i for i in ids if i >= 0]


@lru_cache(maxsize=2)
def load_codec(path: str, pattern: str) -> Codec:
    """A codec from a rank file (base64 token and rank a line); ranks must be gapless from 0."""
    with open(path, "rb") as file:
        ranks = sorted((int(rank), base64.b64decode(token)) for token, rank in map(bytes.split, file))
    if [rank for rank, _ in ranks] != list(range(len(ranks))):
        raise ValueError(f"{path} has gaps or repeated ranks")
    return Codec([token for _, token in ranks], pattern, worker_cache("bpe", path))


def encode_documents(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit integers) and decoded bytes of every whole text."""
    def start():
        codec = load_codec(path, pattern)

        def handle(batch):
            ids = codec.encode(as_texts(batch["text"]))
            return pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()),
                 pa.array([codec.decode(x) for x in ids], pa.binary())],
                ["doc_id", "n_tokens", "ids", "decoded"])
        return handle

    return map_texts(documents.select("doc_id", "text"), _schema(documents, "n_tokens long, ids binary, decoded binary"), start, cache="bpe")


def digest_documents(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """As ``encode_documents``, with SHA-256 digests in place of ids and decoded bytes."""
    def start():
        codec = load_codec(path, pattern)

        def digest(data):
            return hashlib.sha256(data).hexdigest()

        def handle(batch):
            ids = codec.encode(as_texts(batch["text"]))
            return pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(map(digest, ids)),
                 pa.array([digest(codec.decode(x)) for x in ids])],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        return handle

    return map_texts(documents.select("doc_id", "text"),
                     _schema(documents, "n_tokens long, ids_sha256 string, decoded_sha256 string"), start, cache="bpe")


def _schema(documents: DataFrame, rest: str) -> str:
    return f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, {rest}"
