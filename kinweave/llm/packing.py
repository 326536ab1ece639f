"""Packing of tokenized documents into sequences by bin completion.

Documents become pieces of at most ``capacity`` tokens; full pieces are sequences of their own.
The others are dealt into shards of about SHARD_PIECES, in turn from longest to shortest, so that every shard has
the same share of each length, give or take one piece; each shard is packed by itself.

Within a shard a bin is completed around the largest piece left: fillings of its rest are
enumerated one after the other as they are asked for, dominated ones are dropped (a piece could be added, or one piece or two
could be exchanged for a larger single one that fits), and they are tried by waste, TRIED at a time. A branch ends where its
waste so far leaves no way to beat the incumbent, which is the best-fit-decreasing solution at
first. No filling is left out: the search ends at the lower bound on the number of bins, when every branch has ended, or when
the work of WORK_PER_BIN looks at a piece for each bin is used up, with the best solution it has.

Defined cases: null text is empty; every document ends with ``end_id``, so an empty one has length 1.
Repeated rows and null ids are documents like others. An empty table gives an empty result. Columns
other than doc_id and text are not read.
"""

import math
import os
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from kinweave.llm.tables import map_texts, ship_package, worker_cache, written

CAPACITY = 4096
SHARD_PIECES = 4096
CACHED_WORDS = 500_000
CACHED_TEXTS = 1000  # texts whose words are looked up at a time
WORK_PER_BIN = 3000  # the one budget of the search, in looks at a piece
TRIED = 60  # fillings that are put in order of waste at a time
LOOKS_A_SET = 10  # what it costs to ask whether a filling is dominated


class WordEncoder:
    """Ids of texts, word by word: the tokenizer drops white space, and no token spans it.

    Most new words are letters only. They are encoded in runs, and the run's ids are cut behind every
    token that ends a word. A text that holds the string of a special token takes the library's plain
    call as a whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # a word may be one in lower case only
        self.special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values() if token.special]
        vocab = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocab.values()) + 1, bool)
        self.ends_word[[i for token, i in vocab.items() if token.endswith("</w>")]] = True
        self.known: dict[str, bytes] = worker_cache("packing", path)

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers; null is empty.

        Arrow splits the texts and numbers their distinct words; only those are looked up.
        """
        given = pc.fill_null(texts.cast(pa.large_string()), "")
        texts = pc.replace_substring(given, "\n", " ")
        # below U+0100 the lower case of a letter is the tokenizer's; a mark between a letter and a blank is a token of its own
        texts = pc.if_else(pc.match_substring_regex(texts, r"[^\x00-\xFF]"), texts, pc.utf8_lower(texts))
        split = pc.split_pattern(pc.replace_substring_regex(texts, "([a-z])([.,]) ", r"\1 \2 "), " ")
        coded = split.values.dictionary_encode()
        words = coded.dictionary.to_pylist()
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
        self._learn(set(words).difference(self.known))
        found = [self.known[word] for word in words]
        ids, sizes = np.frombuffer(b"".join(found), "<u4"), np.fromiter(map(len, found), np.int64, len(found)) // 4
        place = np.asarray(coded.indices)
        lengths = sizes[place]
        ends = np.cumsum(lengths)
        # the ids of all words in order: each word's run begins where its distinct word's does
        shift = np.repeat((np.cumsum(sizes) - sizes)[place] - (ends - lengths), lengths)
        whole = ids[shift + np.arange(len(shift))]
        bounds = np.append(0, ends)[np.asarray(split.offsets)].tolist()
        encoded = [whole[low:high].tobytes() for low, high in zip(bounds, bounds[1:])]
        self.tokenizer.encode_special_tokens = False
        for string in self.special:
            for at in np.flatnonzero(pc.match_substring(given, string)).tolist():
                found = self.tokenizer.encode(given[at].as_py(), add_special_tokens=False)
                encoded[at] = np.array(found.ids, "<u4").tobytes()
        self.tokenizer.encode_special_tokens = True
        return encoded

    def _learn(self, new: set[str]) -> None:
        plain = [word for word in new if word.isalpha() and (word.isascii() or max(word) < "\u0100")]
        other = list(new.difference(plain))
        for at in range(0, len(plain), 4096):
            run = plain[at:at + 4096]
            self.known.update(zip(run, self._encode_run(run)))
        self.known.update(zip(other, self._encode_each(other)))

    def _encode_run(self, words: list[str]) -> list[bytes]:
        run = self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)
        ids = np.array(run[0].ids, "<u4")
        ends = np.flatnonzero(self.ends_word[ids]) + 1
        if len(ends) != len(words):
            return self._encode_each(words)
        data, bounds = ids.tobytes(), [0, *(4 * ends).tolist()]
        return [data[low:high] for low, high in zip(bounds, bounds[1:])]

    def _encode_each(self, words: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False) if words else []
        return [np.array(word.ids, "<u4").tobytes() for word in found]


@lru_cache(maxsize=2)
def load_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def cut_documents(documents: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 1,
                  with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of every piece of every whole document."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]

    def start():
        encoder, end = load_encoder(path), np.array([end_id], "<u4").tobytes()

        def handle(batch):
            rows = []
            for doc_id, ids in zip(batch["doc_id"].to_pylist(), encoder.encode(batch["text"])):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    rows.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part), part))
            columns = list(zip(*rows)) if rows else [()] * 6
            kinds = [batch["doc_id"].type, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(columns, kinds)][:len(names)], names)
        return handle

    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return map_texts(documents.select("doc_id", "text"), schema, start, CACHED_TEXTS, cache="packing")


def pack_documents(documents: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 1,
                   shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """Every piece with its sequence_id and its offset there."""
    return pack_pieces(written(cut_documents(documents, path, capacity, end_id), "pieces"), capacity, shard_pieces)


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """Add sequence_id and offset to a written table with ``length`` in 1..capacity.

    Full pieces get negative sequence ids, packed ones (shard << 32) + number.
    """
    place = F.monotonically_increasing_id()
    numbered = pieces.withColumn("place", place)
    full = numbered.where(F.col("length") >= capacity).select(
        *pieces.columns, (-1 - F.col("place")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    open_ = dealt(numbered.where(F.col("length") < capacity), pieces.columns, shard_pieces)

    def pack_shard(table: pa.Table) -> pa.Table:
        order = np.lexsort([np.asarray(table[name].fill_null(-1)) for name in ("piece", "ids_crc32", "length")])
        table = table.take(pa.array(order))
        lengths = np.asarray(table["length"])
        bins = pack(lengths.tolist(), capacity)
        sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
        base = table["shard"][0].as_py() << 32
        for number, members in enumerate(bins):
            sequence[members] = base + number
            sizes = lengths[members]
            offset[members] = np.cumsum(sizes) - sizes
        return table.drop_columns(["shard"]).append_column("sequence_id", pa.array(sequence)).append_column(
            "offset", pa.array(offset))

    ship_package(pieces.sparkSession)
    packed = open_.groupBy("shard").applyInArrow(pack_shard, full.schema)
    return full.unionByName(packed)


def dealt(numbered: DataFrame, columns: list[str], shard_pieces: int) -> DataFrame:
    """``columns`` and ``shard`` of rows with a ``place``: dealt in turn from longest to shortest.

    A row's number in that order is that of its length, by the counts of longer ones, plus its rank within the
    length: by the counts of the files' parts before its own and its place there. No length is gathered.
    """
    part = F.shiftright("place", 33)
    counts = written(numbered.groupBy(part.alias("part"), "length").agg(F.count("*").alias("n")), "piece-counts")
    sizes = {row["length"]: row["n"] for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # < capacity rows
    shards = max(1, math.ceil(sum(sizes.values()) / shard_pieces))
    longer, first = 0, []
    for length in sorted(sizes, reverse=True):
        first.append((length, longer))
        longer += sizes[length]
    spark = numbered.sparkSession
    first = spark.createDataFrame(pa.table({"length": pa.array([a for a, _ in first], pa.int64()), "first": pa.array([b for _, b in first], pa.int64())}))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.join(first, "length").select("part", "length", (F.col("first") + F.coalesce(F.sum("n").over(earlier), F.lit(0))).alias("before"))
    inside = F.row_number().over(Window.partitionBy("part", "length").orderBy("place")) - 1
    ranked = numbered.withColumn("part", part).withColumn("inside", inside).join(before, ["part", "length"])
    return ranked.select(*columns, F.pmod(F.col("before") + F.col("inside"), F.lit(shards)).alias("shard"))


def pack(lengths: list[int], capacity: int) -> list[list[int]]:
    """Positions of ``lengths`` by bin; every bin's sum is at most ``capacity``."""
    places: dict[int, list[int]] = {}
    for at, length in enumerate(lengths):
        places.setdefault(length, []).append(at)
    return [[places[length].pop() for length in filling] for filling in pack_sizes(Counter(lengths), capacity)]


def pack_sizes(counts: Counter, capacity: int) -> list[list[int]]:
    best = best_fit(counts, capacity)
    total = sum(size * n for size, n in counts.items())
    bound = lower_bound(counts, capacity)
    work = Work(WORK_PER_BIN * (len(best) + 1))
    while len(best) > bound and work.left > 0:
        found = complete(counts, capacity, (len(best) - 1) * capacity - total, work)
        if found is None:
            break
        best = found
    return best


class Work:
    """What is left of a budget."""

    def __init__(self, left: int):
        self.left = left


def lower_bound(counts: Counter, capacity: int) -> int:
    """Bins that any packing needs: by the sum, and with pieces that pair with none or few others."""
    sizes = sorted(counts)
    total = sum(size * n for size, n in counts.items())
    bound = -(-total // capacity)
    for cut in (size for size in sizes if 2 * size <= capacity):
        alone = sum(n for size, n in counts.items() if size > capacity - cut)
        half = [(size, n) for size, n in counts.items() if capacity < 2 * size and size <= capacity - cut]
        room = sum(n * (capacity - size) for size, n in half)
        rest = sum(n * size for size, n in counts.items() if cut <= size and 2 * size <= capacity)
        bound = max(bound, alone + sum(n for _, n in half) + max(0, -(-(rest - room) // capacity)))
        if cut > capacity // 8:  # larger cuts rarely bind and each costs a pass
            break
    return bound


def best_fit(counts: Counter, capacity: int) -> list[list[int]]:
    """Best-fit decreasing: each piece goes to the fullest bin that takes it."""
    rooms: list[int] = []  # sorted distinct rooms
    by_room: dict[int, list[list[int]]] = {}
    bins = []
    for size in sorted(counts, reverse=True):
        for _ in range(counts[size]):
            at = bisect_left(rooms, size)
            if at < len(rooms):
                room = rooms[at]
                bin_ = by_room[room].pop()
                if not by_room[room]:
                    del by_room[room], rooms[at]
            else:
                room, bin_ = capacity, []
                bins.append(bin_)
            bin_.append(size)
            left = room - size
            if left:
                if left not in by_room:
                    by_room[left] = []
                    rooms.insert(bisect_left(rooms, left), left)
                by_room[left].append(bin_)
    return bins


def complete(counts: Counter, capacity: int, waste: int, work: Work) -> list[list[int]] | None:
    """Depth-first bin completion with at most ``waste`` tokens unused in all bins.

    Returns the bins, or None if there is no such packing or the work is used up.
    """
    left, sizes = dict(counts), sorted(counts)

    def take(filling):
        for size in filling:
            left[size] -= 1
            if not left[size]:
                del sizes[bisect_left(sizes, size)]

    def put_back(filling):
        for size in filling:
            if not left[size]:
                sizes.insert(bisect_left(sizes, size), size)
            left[size] += 1

    done: list[list[int]] = []
    choices: list[Iterator[list[int]]] = []
    while sizes:
        # a choice is asked for its next filling only when the pieces are as they were when it was made
        choices.append(fillings(left, sizes, sizes[-1], capacity - sizes[-1], waste, work))
        chosen = next(choices[-1], None)
        while chosen is None:
            choices.pop()
            if not choices or work.left <= 0:
                return None
            undone = done.pop()
            put_back(undone)
            waste += capacity - sum(undone)
            chosen = next(choices[-1], None)
        take(chosen)
        done.append(chosen)
        waste -= capacity - sum(chosen)
    return done


def fillings(left: dict[int, int], sizes: list[int], largest: int, room: int, waste: int, work: Work) -> Iterator[list[int]]:
    """Undominated bins around ``largest`` with at most ``waste`` unused, TRIED at a time in order of waste, as they are asked for."""
    sets = maximal_sets(left, sizes, largest, room, work)
    while some := list(islice(sets, TRIED)):
        work.left -= LOOKS_A_SET * len(some)
        kept = [chosen for chosen in some if room - sum(chosen) <= waste and not _dominated(chosen, room - sum(chosen), largest, left, sizes)]
        for chosen in sorted(kept, key=lambda c: (-sum(c), len(c))):
            yield [largest, *chosen]


def maximal_sets(left: dict[int, int], sizes: list[int], largest: int, room: int, work: Work) -> Iterator[list[int]]:
    """Sets of pieces beside ``largest``, from longest to shortest, that no further one of at most the last's size fits into.

    The sets with one longest piece are a branch. Branches begin one by one and take turns, so that the first sets differ
    in more than their last pieces.
    """
    branches: list[Iterator[list[int]]] = []
    at, empty = bisect_right(sizes, room) - 1, True
    while at >= 0 or branches:
        while at >= 0:
            work.left -= 1
            size = sizes[at]
            at -= 1
            if left[size] > (size == largest):
                branches.append(_branch(left, sizes, largest, size, room - size, work))
                break
        ended = []
        for branch in branches:
            chosen = next(branch, None)
            if chosen is None:
                ended.append(branch)
            else:
                empty = False
                yield chosen
        for branch in ended:
            branches.remove(branch)
        if work.left <= 0:
            return
    if empty:
        yield []


def _branch(left: dict[int, int], sizes: list[int], largest: int, first: int, room: int, work: Work) -> Iterator[list[int]]:
    """The sets whose longest piece is ``first``."""
    chosen: list[int] = [first]
    used: dict[int, int] = {largest: 1}
    used[first] = used.get(first, 0) + 1
    at = bisect_right(sizes, min(first, room)) - 1
    while True:
        while at >= 0 and work.left > 0:
            work.left -= 1
            size = sizes[at]
            if size > room:
                at = bisect_right(sizes, room) - 1
            elif left[size] > used.get(size, 0):
                chosen.append(size)
                used[size] = used.get(size, 0) + 1
                room -= size
            else:
                at -= 1
        if work.left <= 0:
            return
        yield list(chosen)
        # the last piece gives way to the next smaller one; where there is none, the one before it does
        while len(chosen) > 1:
            size = chosen.pop()
            used[size] -= 1
            room += size
            at = bisect_left(sizes, size) - 1
            if at >= 0 and _any_left(left, sizes, used, at, work):
                break
        else:
            return


def _any_left(left: dict[int, int], sizes: list[int], used: dict[int, int], at: int, work: Work) -> bool:
    """Whether a piece of the size at ``at`` or a smaller one is left."""
    while at >= 0:
        work.left -= 1
        if left[sizes[at]] > used.get(sizes[at], 0):
            return True
        at -= 1
    return False


def _dominated(chosen: list[int], slack: int, largest: int, left: dict[int, int], sizes: list[int]) -> bool:
    def free_between(low, high):
        at = bisect_left(sizes, low)
        while at < len(sizes) and sizes[at] <= high:
            if left[sizes[at]] > chosen.count(sizes[at]) + (sizes[at] == largest):
                return True
            at += 1
        return False

    if slack and free_between(1, slack):
        return True
    if slack and any(free_between(size + 1, size + slack) for size in chosen):
        return True
    return len(chosen) > 1 and free_between(chosen[-1] + chosen[-2], chosen[-1] + chosen[-2] + slack)
