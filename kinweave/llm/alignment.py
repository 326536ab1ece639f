"""Alignment of the tokens that two tokenizers cut the same text into.

Tokenizer A is byte-level and encodes a space and the text; tokenizer B marks word starts with U+2581 and adds
the space itself. Where tokens of both end at the same byte a group ends. An A and a B token are
linked where their bytes overlap, so a group of p and q tokens has p + q - 1 links: one for each
stretch between two neighbouring ends.

Identity map: for every A id the B id with the same bytes, as one array. Groups of one A and one B token that the
map predicts are counted in a vector of the length of A's vocabulary, one vector a task. Only
the links of other groups are pairs that enter the shuffle, added up within a batch before. The
counts of both make one table of pairs.

Scores need the count of every link. The vectors of predicted pairs and of each B id's highest
count are as long as the vocabularies and go to all tasks, and so do the most frequent other pairs, at
most HOT_PAIRS of them, by a power of two as the least count. A document's rarer pairs are joined with the
table of pairs; each of those has fewer rows than that least count, so no key is hot.

Texts are cut before a space or line end that follows a character that is no white space, and before a comma or full stop
behind an ASCII letter. No token of either vocabulary spans such a place (A: its pattern has none; B: checked when the vocabulary is loaded), so
the distinct parts of a batch are encoded and aligned once, and a worker keeps up to CACHED_PARTS of them.

Defined cases: texts that are null, empty or whose joined bytes by A or B differ from space and text have no tokens and
all numbers 0. Strings of special tokens are plain text. Repeated rows and null ids are documents
like others, and each of their links counts. An empty table gives an empty result. Columns other
than doc_id and text are not read.
"""

import hashlib
import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from kinweave.llm.tables import as_bytes, map_texts, ship_package, small_batches, worker_cache, written

CACHED_PARTS = 300_000
TEXTS = 500  # texts whose parts are looked up at a time
HOT_PAIRS = 1 << 18


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, others from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in printable]
    return {chr(byte): byte for byte in printable} | {chr(0x100 + n): byte for n, byte in enumerate(others)}


class Vocabularies:
    """Both tokenizers, the bytes of their tokens and the identity map."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        alphabet = byte_alphabet()
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            if all(c in alphabet for c in token):
                self.a_bytes[i] = bytes(alphabet[c] for c in token)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any("\n" in piece or "▁" in piece.lstrip("▁") or re.search("[A-Za-z][.,]", piece) for piece in pieces):
            raise ValueError(f"a piece of {path_b} spans a word start, a line end or the end of a word")
        self.b_bytes = [bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()
                        for i, piece in enumerate(pieces)]
        first = {}
        for i in sorted(range(len(pieces)), key=lambda i: (self.b.is_byte(i), i)):
            first.setdefault(self.b_bytes[i], i)
        self.same = np.array([first.get(value, -1) if value else -1 for value in self.a_bytes], np.int64)
        self.a_length = np.array([*map(len, self.a_bytes)], np.int64)
        self.b_length = np.array([*map(len, self.b_bytes)], np.int64)
        self.code_type = "<u4" if len(self.a_bytes) * len(pieces) <= 1 << 32 else "<u8"
        # ids as text with what stands behind them in a digest: within a group, at its end, for A and for B
        text = [[b"%d%s" % (i, mark) for i in range(n)]
                for n, mark in ((len(self.a_bytes), b","), (len(self.a_bytes), b"|"), (len(pieces), b","), (len(pieces), b";"))]
        self.marked = np.array([value for part in text for value in part], object)

    def code(self, a, b):
        return a * len(self.b_bytes) + b

    def encode_parts(self, parts: list[bytes]) -> tuple[list[list[int]], list[list[int]]]:
        """The ids of parts of texts by A and by B.

        B puts a space before what it is given, but not before an empty text. A part that begins with a space gets it from B; one
        that is a space only gets its id; others are given behind a line end, which no piece spans.
        """
        texts = [part.decode() for part in parts]
        ids_a = [found.ids for found in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        given = [text[1:] if text[0] == " " else "\n" + text.removeprefix("\n") for text in texts]
        ids_b = self.b.encode(given, num_threads=1)
        space = [self.b.piece_to_id("▁")]
        added = {" ": 0, "\n": 1}
        return ids_a, [space if text == " " else ids[added.get(text[0], 2):] for text, ids in zip(texts, ids_b)]


@lru_cache(maxsize=1)
def load_vocabularies(path_a: str, path_b: str) -> Vocabularies:
    return Vocabularies(path_a, path_b)


def split_parts(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The parts of a space and each text, numbered by distinct part, and the bounds of each text's parts."""
    encoded = as_bytes(texts)
    sizes = np.fromiter(map(len, encoded), np.int64, len(encoded))
    data = b" ".join([b"", *encoded])
    buffer = np.frombuffer(data, np.uint8)
    begins = np.cumsum(sizes + 1) - (sizes + 1)
    blank = (buffer == 0x20) | (buffer == 0x0A)
    before = np.empty_like(buffer)
    before[:1], before[1:] = 0, buffer[:-1]
    # behind ASCII: above the space; behind other characters: none of those that share a first byte with white space
    solid = (before > 0x20) & (before != 0x7F)
    tail = before >= 0x80
    if tail.any():
        two, three = np.zeros_like(buffer), np.zeros_like(buffer)
        two[2:], three[3:] = buffer[:-2], buffer[:-3]
        solid &= ~(tail & ((two == 0xC2) | ((three >= 0xE1) & (three <= 0xE3))))
    letter = ((before | 0x20) >= 0x61) & ((before | 0x20) <= 0x7A)
    cuts = blank & solid | letter & ((buffer == 0x2C) | (buffer == 0x2E))
    cuts[begins] = True
    starts = np.flatnonzero(cuts)
    offsets = np.append(starts, len(buffer)).astype(np.int64)
    parts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return parts.dictionary_encode(), np.append(np.searchsorted(starts, begins), len(starts))


class Aligner:
    """Alignments of the distinct parts of texts; a part is (tokens of A, of B, groups, digest text, predicted ids, other codes)."""

    def __init__(self, path_a: str, path_b: str):
        self.vocabularies = load_vocabularies(path_a, path_b)
        self.known: dict[bytes, tuple | None] = worker_cache("alignment", (path_a, path_b))

    def look_up(self, parts: list[bytes]) -> list[tuple | None]:
        if len(self.known) > CACHED_PARTS:
            self.known.clear()
        new = [part for part in parts if part not in self.known]
        for at in range(0, len(new), 20_000):
            self.known.update(zip(new[at:at + 20_000], self._align(new[at:at + 20_000])))
        return [self.known[part] for part in parts]

    def _align(self, parts: list[bytes]) -> list[tuple | None]:
        """The alignment of each part; None where the bytes of its tokens are not its own."""
        v = self.vocabularies
        ids_a, ids_b = v.encode_parts(parts)
        fits = [b"".join([v.a_bytes[i] for i in a]) == part == b"".join([v.b_bytes[i] for i in b])
                for part, a, b in zip(parts, ids_a, ids_b)]
        ids_a = [ids for ids, fit in zip(ids_a, fits) if fit]
        ids_b = [ids for ids, fit in zip(ids_b, fits) if fit]
        n_a, n_b = (np.fromiter(map(len, ids), np.int64, len(ids)) for ids in (ids_a, ids_b))
        a, b = (np.fromiter((i for row in ids for i in row), np.int64) for ids in (ids_a, ids_b))
        # the parts one behind the other: ends of tokens, of groups (ends of both), of links (ends of either)
        end_a, end_b = np.cumsum(v.a_length[a]), np.cumsum(v.b_length[b])
        group_end = np.intersect1d(end_a, end_b, assume_unique=True)
        link_end = np.union1d(end_a, end_b)
        group_a, group_b, group_link = (np.searchsorted(group_end, ends) for ends in (end_a, end_b, link_end))
        link_a, link_b = a[np.searchsorted(end_a, link_end)], b[np.searchsorted(end_b, link_end)]
        size_a, size_b = np.bincount(group_a, minlength=len(group_end)), np.bincount(group_b, minlength=len(group_end))
        predicted = ((size_a == 1) & (size_b == 1))[group_link] & (v.same[link_a] == link_b)
        codes = v.code(link_a, link_b)
        # the digest text: tokens of A and B of a group side by side, each with its mark
        texts = np.empty(len(a) + len(b), object)
        last_a, last_b = np.isin(end_a, group_end, assume_unique=True), np.isin(end_b, group_end, assume_unique=True)
        before_a, before_b = np.cumsum(size_b) - size_b, np.cumsum(size_a)
        marks_a, marks_b = len(v.a_bytes), len(v.b_bytes)
        texts[np.arange(len(a)) + before_a[group_a]] = v.marked[a + marks_a * last_a]
        texts[np.arange(len(b)) + before_b[group_b]] = v.marked[b + 2 * marks_a + marks_b * last_b]
        texts = texts.tolist()
        token_at, part_end = np.append(0, np.cumsum(n_a + n_b)), end_a[np.cumsum(n_a) - 1] if len(n_a) else end_a
        group_at = np.append(0, np.searchsorted(group_end, part_end, "right"))
        link_at = np.append(0, np.searchsorted(link_end, part_end, "right"))
        same_at, other_at = (np.append(0, np.cumsum(flag))[link_at] for flag in (predicted, ~predicted))
        same, other = link_a[predicted].astype("<u4"), codes[~predicted].astype(v.code_type)
        found = iter([
            (int(n_a[k]), int(n_b[k]), int(group_at[k + 1] - group_at[k]), b"".join(texts[token_at[k]:token_at[k + 1]]),
             same[same_at[k]:same_at[k + 1]].tobytes(), other[other_at[k]:other_at[k + 1]].tobytes())
            for k in range(len(ids_a))])
        return [next(found) if fit else None for fit in fits]

    def align(self, texts: pa.Array) -> list[tuple]:
        """(n_a, n_b, n_groups, n_links, groups_sha256, predicted ids, their counts, other codes, their counts) of each text."""
        v = self.vocabularies
        parts, bounds = split_parts(texts)
        found = self.look_up(parts.dictionary.to_pylist())
        numbers = np.array([part[:3] if part else (0, 0, 0) for part in found], np.int64).reshape(-1, 3)
        strings = [part[3] if part else b"" for part in found]
        place = np.asarray(parts.indices).astype(np.int64)
        sums = np.concatenate([np.zeros((1, 3), np.int64), np.cumsum(numbers[place], axis=0)])
        sums = sums[bounds[1:]] - sums[bounds[:-1]]
        broken = np.append(0, np.cumsum(np.array([part is None for part in found], bool)[place]))
        some = np.asarray(pc.fill_null(pc.greater(pc.binary_length(texts), 0), False).to_numpy(zero_copy_only=False), bool)
        fits = some & (broken[bounds[1:]] == broken[bounds[:-1]])
        text_of = np.repeat(np.arange(len(texts)), np.diff(bounds))
        text_of, place_of = text_of[fits[text_of]], place[fits[text_of]]
        same = _per_text(text_of, place_of, [part[4] if part else b"" for part in found], "<u4", len(texts))
        other = _per_text(text_of, place_of, [part[5] if part else b"" for part in found], v.code_type, len(texts))
        rows = []
        for at, fit in enumerate(fits.tolist()):
            if not fit:
                rows.append((0, 0, 0, 0, "", b"", b"", b"", b""))
                continue
            n_a, n_b, n_groups = sums[at].tolist()
            digest = b"".join([strings[number] for number in place[bounds[at]:bounds[at + 1]].tolist()])[:-1]
            rows.append((n_a, n_b, n_groups, n_a + n_b - n_groups, hashlib.sha256(digest).hexdigest(), *same[at], *other[at]))
        return rows


def _per_text(text_of: np.ndarray, place_of: np.ndarray, values: list[bytes], kind: str, n_texts: int) -> list[tuple[bytes, bytes]]:
    """For each text the distinct values of all its parts and how often it has each, as bytes."""
    flat = np.frombuffer(b"".join(values), kind).astype(np.int64)
    sizes = np.fromiter(map(len, values), np.int64, len(values)) // np.dtype(kind).itemsize
    lengths = sizes[place_of]
    ends = np.cumsum(lengths)
    taken = flat[np.repeat((np.cumsum(sizes) - sizes)[place_of] - (ends - lengths), lengths) + np.arange(lengths.sum())]
    text = np.repeat(text_of, lengths)
    out = []
    bounds = np.searchsorted(text, np.arange(n_texts + 1))
    for low, high in zip(bounds.tolist(), bounds[1:].tolist()):
        distinct, counts = np.unique(taken[low:high], return_counts=True)
        out.append((distinct.astype(kind).tobytes(), counts.astype("<u4").tobytes()))
    return out


def align_documents(documents: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """place, doc_id, n_a, n_b, n_groups, n_links, groups_sha256 and the links of every document: distinct ones and counts."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    names = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "same", "same_n", "other", "other_n"]
    kinds = [pa.int64()] * 4 + [pa.string()] + [pa.binary()] * 4
    schema = (f"place long, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
              "same binary, same_n binary, other binary, other_n binary")

    def start():
        aligner = Aligner(path_a, path_b)

        def handle(batch):
            rows = aligner.align(batch["text"])
            columns = list(zip(*rows)) if rows else [()] * len(names)
            return pa.RecordBatch.from_arrays([batch["place"], batch["doc_id"], *map(pa.array, columns, kinds)],
                                              ["place", "doc_id", *names])
        return handle

    read = documents.select(F.monotonically_increasing_id().alias("place"), "doc_id", "text")
    return map_texts(read, schema, start, TEXTS, cache="alignment")


def count_pairs(aligned: DataFrame, same: np.ndarray, n_b: int, code_type: str) -> DataFrame:
    """(code, n): how many links of the corpus join each pair. Predicted pairs are added up in one vector a task."""
    def run(batches):
        vector = np.zeros(len(same), np.int64)
        for given in batches:
            for batch in small_batches(given):
                ids, counts = (_flat(batch[name], "<u4")[0] for name in ("same", "same_n"))
                vector += np.bincount(ids.astype(np.int64), counts, len(same)).astype(np.int64)
                codes, counts = _flat(batch["other"], code_type)[0], _flat(batch["other_n"], "<u4")[0]
                distinct, place = np.unique(codes, return_inverse=True)
                yield _pairs(distinct, np.bincount(place, counts, len(distinct)))
        some = np.flatnonzero(vector)
        yield _pairs(some * n_b + same[some], vector[some])

    ship_package(aligned.sparkSession)
    pairs = aligned.select("same", "same_n", "other", "other_n").mapInArrow(run, "code long, n long")
    return pairs.groupBy("code").agg(F.sum("n").alias("n"))


def _pairs(codes: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(codes.astype(np.int64)), pa.array(counts.astype(np.int64))], ["code", "n"])


def _flat(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of a column of bytes in one array, and how many each row has."""
    values = column.to_pylist()
    sizes = np.fromiter(map(len, values), np.int64, len(values)) // np.dtype(kind).itemsize
    return np.frombuffer(b"".join(values), kind), sizes


def hot_least(pairs: DataFrame, most: int) -> int:
    """The smallest power of two that at most ``most`` pairs have as their count."""
    level = F.floor(F.log2("n")).cast("int")
    levels = {row.level: row.pairs for row in pairs.groupBy(level.alias("level")).agg(F.count("*").alias("pairs")).collect()}
    total, least = 0, max(levels, default=0) + 1
    while least > 0 and total + levels.get(least - 1, 0) <= most:
        least -= 1
        total += levels.get(least, 0)
    return 1 << least


def score_documents(documents: DataFrame, path_a: str, path_b: str, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document."""
    v = load_vocabularies(path_a, path_b)
    same, n_b, code_type = v.same, len(v.b_bytes), v.code_type
    aligned = written(align_documents(documents, path_a, path_b), "aligned")
    pairs = written(count_pairs(aligned, same, n_b, code_type), "aligned-pairs")

    best = np.zeros(n_b, np.int64)
    for row in pairs.groupBy((F.col("code") % n_b).alias("b")).agg(F.max("n").alias("n")).collect():  # a row per B id
        best[row.b] = row.n
    hot_codes, hot_counts = _collected(pairs.where(F.col("n") >= hot_least(pairs, hot_pairs)))  # at most hot_pairs rows
    predicted = written(_predicted(pairs, same, n_b), "aligned-predicted")
    same_codes, same_counts = _collected(predicted)  # at most a row per A id
    same_total = np.zeros(len(same), np.int64)
    same_total[same_codes // n_b] = same_counts
    same_best = same_total == best[same]

    def score(batch):
        rows = np.arange(batch.num_rows)
        ids, sizes = _flat(batch["same"], "<u4")
        times, row = _flat(batch["same_n"], "<u4")[0].astype(np.int64), np.repeat(rows, sizes)
        total, n_best = _sums(row, times * same_total[ids], len(rows)), _sums(row, times * same_best[ids], len(rows))
        codes, sizes = _flat(batch["other"], code_type)
        codes, times, row = codes.astype(np.int64), _flat(batch["other_n"], "<u4")[0].astype(np.int64), np.repeat(rows, sizes)
        at = np.minimum(np.searchsorted(hot_codes, codes), max(len(hot_codes) - 1, 0))
        known = hot_codes[at] == codes if len(hot_codes) else np.zeros(len(codes), bool)
        counts = hot_counts[at[known]]
        total += _sums(row[known], times[known] * counts, len(rows))
        n_best += _sums(row[known], times[known] * (counts == best[codes[known] % n_b]), len(rows))
        offsets = pa.array(np.append(0, np.cumsum(np.bincount(row[~known], minlength=len(rows)))), pa.int32())
        return pa.RecordBatch.from_arrays([
            *(batch[name] for name in ("place", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")),
            pa.array(n_best), pa.array(total), pa.ListArray.from_arrays(offsets, pa.array(codes[~known])),
            pa.ListArray.from_arrays(offsets, pa.array(times[~known]))],
            ["place", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum", "rare", "rare_n"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = (f"place long, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
              "n_best long, count_sum long, rare array<long>, rare_n array<long>")
    scored = written(map_texts(aligned, schema, lambda: score), "aligned-scores")
    rare = scored.where(F.size("rare") > 0).select("place", F.explode(F.arrays_zip("rare", "rare_n")).alias("link")).select(
        "place", F.col("link.rare").alias("code"), F.col("link.rare_n").alias("times"))
    highest = pairs.groupBy((F.col("code") % n_b).alias("b")).agg(F.max("n").alias("highest"))
    added = rare.join(pairs, "code").withColumn("b", F.col("code") % n_b).join(highest, "b").groupBy("place").agg(
        F.sum(F.col("times") * F.col("n")).alias("rare_sum"),
        F.sum(F.when(F.col("n") == F.col("highest"), F.col("times")).otherwise(0)).alias("rare_best"))
    zero = F.lit(0).cast("long")
    return scored.drop("rare", "rare_n").join(added, "place", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", (F.col("n_best") + F.coalesce("rare_best", zero)).alias("n_best"),
        (F.col("count_sum") + F.coalesce("rare_sum", zero)).alias("count_sum"), "groups_sha256")


def _predicted(pairs: DataFrame, same: np.ndarray, n_b: int) -> DataFrame:
    """The rows of ``pairs`` that the identity map predicts."""
    def run(batch):
        codes = np.asarray(batch["code"])
        return batch.filter(pa.array(same[codes // n_b] == codes % n_b))

    return map_texts(pairs, "code long, n long", lambda: run)


def _collected(pairs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """A bounded number of pairs as arrays, sorted by code."""
    table = pairs.select("code", "n").toArrow()
    codes, counts = np.asarray(table["code"]), np.asarray(table["n"])
    order = np.argsort(codes)
    return codes[order], counts[order]


def _sums(rows: np.ndarray, values: np.ndarray, n_rows: int) -> np.ndarray:
    """Exact sums of whole numbers by row; ``rows`` is sorted."""
    total = np.append(0, np.cumsum(values.astype(np.int64)))
    bounds = np.searchsorted(rows, np.arange(n_rows + 1))
    return total[bounds[1:]] - total[bounds[:-1]]
