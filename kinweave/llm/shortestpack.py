"""Packing of tokenized documents by shortest-pack-first over the histogram of their lengths.

Every document becomes full pieces of ``capacity`` tokens, sequences of their own, and one shorter rest.
Only the histogram of the rests is packed, on the driver: it has fewer than ``capacity`` entries however
many documents there are. Lengths are placed longest first, each into the packs with the most room
left, whole groups of equal packs at a time: a pattern (what a pack holds) has a count, and
placing n of a length updates counts and splits at most one pattern. A length that fits nowhere opens packs.

Patterns are joined back to documents by rank: the n documents of a length are numbered 0 to n - 1,
and each pattern takes a run of these ranks. Ranks come from a count within the task that tokenized
the document and from the counts of the tasks before, so no length is ever sorted or gathered.

Padding is removed by cutting few documents. A packing of T tokens cannot do with fewer than T // capacity
full sequences. So many of the fullest packs stay; the others, the emptiest, are taken apart, and their documents,
laid end to end in one stream, fill the gaps of those that stay. Gaps shorter than ``least_gap``
stay padded. What the gaps leave over goes into full sequences and, at the end, into at most
log2(capacity) sequences whose lengths are powers of two, which need no padding.

Bounds: the plan has at most three patterns a distinct length, and a pattern at most sqrt(2 * capacity)
distinct lengths, whatever the number of documents; it travels to the tasks as a few arrays. The ids
of the rests are kept in the written table and read again for the documents that are cut.

Defined cases: null text is empty; every document ends with ``end_id``, so an empty one has length 1.
Repeated rows and null ids are documents like others. An empty table gives an empty result. Strings of
special tokens are read as the library's plain call reads them. Columns other than doc_id and text are
not read.
"""

import zlib
from bisect import insort
from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from kinweave.llm.packing import load_encoder
from kinweave.llm.tables import map_texts, written

CAPACITY = 4096
TEXTS = 1000  # texts whose words are looked up at a time
RANK_BITS = 48


def tokenize(documents: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 2) -> DataFrame:
    """One row a document: its lengths, digests of its natural pieces, the ids of its rest, its number in its task.

    ``nth`` counts the documents with the same rest that the task ``task`` met before, ``full_before``
    the full pieces. Both hold for a written result only.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {kind}, doc_tokens long, rest int, digests array<long>, ids binary, "
              "task int, nth long, full_before long")

    def start():
        encoder, end = load_encoder(path), np.array([end_id], "<u4").tobytes()
        task, seen, full = TaskContext.get().partitionId(), np.zeros(capacity, np.int64), 0

        def handle(batch):
            nonlocal full
            rows = []
            for ids in encoder.encode(batch["text"]):
                ids += end
                tokens = len(ids) // 4
                n_full, rest = divmod(tokens, capacity)
                digests = [zlib.crc32(ids[at:at + 4 * capacity]) for at in range(0, len(ids), 4 * capacity)]
                rows.append((tokens, rest, digests, _narrow(ids[4 * capacity * n_full:]), task, int(seen[rest]), full))
                seen[rest] += 1
                full += n_full
            columns = list(zip(*rows)) if rows else [()] * 7
            kinds = [pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.binary(), pa.int32(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [batch["doc_id"], *map(pa.array, columns, kinds)],
                ["doc_id", "doc_tokens", "rest", "digests", "ids", "task", "nth", "full_before"])
        return handle

    return map_texts(documents.select("doc_id", "text"), schema, start, TEXTS, cache="packing")


def _narrow(ids: bytes) -> bytes:
    """Ids in two bytes each where all of them fit; the number of ids tells which it is."""
    wide = np.frombuffer(ids, "<u4")
    return wide.astype("<u2").tobytes() if len(wide) and wide.max() < 65536 else ids


def _wide(ids: bytes, number: int) -> bytes:
    return np.frombuffer(ids, "<u2").astype("<u4").tobytes() if len(ids) == 2 * number else ids


@dataclass
class Pattern:
    """``count`` packs that each hold the same lengths, as (length, times) from longest to shortest."""

    count: int
    holds: tuple[tuple[int, int], ...]
    used: int


def shortest_pack_first(histogram: Mapping[int, int], capacity: int) -> list[Pattern]:
    """Patterns that place every length of the histogram (length -> number), longest first, most room first."""
    by_room: dict[int, list[tuple[int, tuple]]] = {}
    rooms: list[int] = []  # sorted, of all packs that are not full

    def add(room, count, holds):
        if room not in by_room:
            by_room[room] = []
            insort(rooms, room)
        by_room[room].append((count, holds))

    def with_more(holds, length, times):
        if holds and holds[-1][0] == length:
            return *holds[:-1], (length, holds[-1][1] + times)
        return *holds, (length, times)

    for length in sorted(histogram, reverse=True):
        n = histogram[length]
        while n:
            room = rooms[-1] if rooms else 0
            if room < length:
                each = capacity // length
                for count, times in ((n // each, each), (1, n % each)):
                    if count and times:
                        add(capacity - times * length, count, ((length, times),))
                break
            count, holds = by_room[room].pop()
            if not by_room[room]:
                del by_room[room]
                rooms.pop()
            # a group stays the one with the most room until it comes down to the next one's
            below = rooms[-1] if rooms else 0
            times = min(max((room - below) // length, 1), room // length, max(n // count, 1))
            taken = min(count, n) if times == 1 else count
            add(room - times * length, taken, with_more(holds, length, times))
            if taken < count:
                add(room, count - taken, holds)
            n -= taken * times
    return [Pattern(count, holds, capacity - room) for room in reversed(rooms) for count, holds in by_room[room]][::-1]


@dataclass
class Plan:
    """Where every rank of every length goes, as arrays.

    ``runs``: key (length << RANK_BITS | first rank), sorted, and for each run its first sequence (or first place
    in the stream), times a pack, offset, and whether it goes to the stream. ``slots``: first place in the stream, sorted,
    length, first sequence, offset of runs of equal slots that the stream fills.
    """

    key: np.ndarray
    first: np.ndarray
    times: np.ndarray
    offset: np.ndarray
    streamed: np.ndarray
    slot_start: np.ndarray
    slot_length: np.ndarray
    slot_sequence: np.ndarray
    slot_offset: np.ndarray

    def cut(self, place: int, length: int) -> list[tuple[int, int, int, int]]:
        """(start, length, sequence, offset) of the parts of a document that lies at ``place`` of the stream."""
        parts, done = [], 0
        while done < length:
            at = int(np.searchsorted(self.slot_start, place + done, "right")) - 1
            number, inside = divmod(place + done - int(self.slot_start[at]), int(self.slot_length[at]))
            size = min(length - done, int(self.slot_length[at]) - inside)
            parts.append((done, size, int(self.slot_sequence[at]) + number, int(self.slot_offset[at]) + inside))
            done += size
        return parts


def make_plan(patterns: list[Pattern], capacity: int, least_gap: int = 1) -> Plan:
    """Keep the fullest packs, take the others apart, and lay the stream of their documents into gaps and new sequences."""
    total = sum(p.count * p.used for p in patterns)
    keep, sequence, stream = total // capacity, 0, 0
    ranks: dict[int, int] = {}
    runs, gaps = [], []
    for pattern in sorted(patterns, key=lambda p: -p.used):
        kept = min(keep, pattern.count)
        keep -= kept
        for count, streamed in ((kept, False), (pattern.count - kept, True)):
            offset = 0
            for length, times in pattern.holds if count else ():
                rank = ranks.get(length, 0)
                ranks[length] = rank + count * times
                runs.append((length << RANK_BITS | rank, stream if streamed else sequence, times, offset, streamed))
                offset += length * times
                stream += count * times * length if streamed else 0
            if count and not streamed:
                if capacity - offset >= least_gap:
                    gaps.append((capacity - offset, count, sequence, offset))
                sequence += count
    slots, place = [], 0
    for length, count, first, offset in gaps:
        slots.append((place, length, first, offset))
        place += length * count
    new = max(0, stream - place) // capacity
    sizes = [(capacity, new)] if new else []
    tail = max(0, stream - place - new * capacity)
    sizes += [(1 << bit, 1) for bit in reversed(range(tail.bit_length())) if tail >> bit & 1]
    for length, count in sizes:
        slots.append((place, length, sequence, 0))
        place += length * count
        sequence += count
    runs.sort()
    columns = list(zip(*runs)) if runs else [()] * 5
    places = list(zip(*slots)) if slots else [()] * 4
    return Plan(*[np.array(c, np.int64) for c in columns[:4]], np.array(columns[4], bool),
                *[np.array(c, np.int64) for c in places])


def pack_documents(documents: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 2,
                   least_gap: int = 1) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of every piece.

    Full pieces have negative sequence ids, (task, number) as one number; the others count from 0.
    """
    docs = written(tokenize(documents, path, capacity, end_id), "shortest-pack-docs")
    counts = written(docs.where("rest > 0").groupBy("task", "rest").agg(F.count("*").alias("n")), "shortest-pack-counts")
    histogram = {row.rest: row.n for row in counts.groupBy("rest").agg(F.sum("n").alias("n")).collect()}  # < capacity rows
    plan = make_plan(shortest_pack_first(histogram, capacity), capacity, least_gap)

    earlier = Window.partitionBy("rest").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("task", "rest", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = docs.drop("ids").join(before, ["task", "rest"], "left").select(
        "doc_id", "doc_tokens", "rest", "digests", "task", "nth", "full_before", (F.col("before") + F.col("nth")).alias("rank"))
    placed = written(place_documents(ranked, plan, capacity), "shortest-pack-placed")
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    cutting = written(placed.where(F.col("stream").isNotNull()).select("task", "length", "nth", "stream"), "shortest-pack-cut")
    material = docs.select("doc_id", "doc_tokens", "ids", "task", F.col("rest").cast("long").alias("length"), "nth")
    cut = cut_documents(material.join(cutting, ["task", "length", "nth"]), plan)
    return placed.where(F.col("stream").isNull()).select(*columns).unionByName(cut.select(*columns))


def place_documents(ranked: DataFrame, plan: Plan, capacity: int) -> DataFrame:
    """Natural pieces with their sequence and offset; a rest that must be cut has its place in the stream instead."""
    kind = ranked.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
              "stream long, task int, nth long")

    def handle(batch):
        column = {name: np.asarray(batch[name].fill_null(0)) for name in ("doc_tokens", "rest", "task", "nth", "full_before", "rank")}
        n_full, rest = column["doc_tokens"] // capacity, column["rest"].astype(np.int64)
        # full pieces: as many rows a document, numbered within it
        rows = np.repeat(np.arange(len(rest)), n_full)
        number = np.arange(len(rows)) - np.repeat(np.cumsum(n_full) - n_full, n_full)
        full_sequence = -1 - ((column["task"][rows].astype(np.int64) << 40) + column["full_before"][rows] + number)
        # rests: the run of ranks that holds the document's
        some = np.flatnonzero(rest > 0)
        at = np.searchsorted(plan.key, (rest[some] << RANK_BITS) + column["rank"][some], "right") - 1
        inside = column["rank"][some] - (plan.key[at] & (1 << RANK_BITS) - 1)
        streamed, times = plan.streamed[at], plan.times[at]
        sequence, copy = plan.first[at] + inside // times, inside % times
        offset = plan.offset[at] + copy * rest[some]
        stream = plan.first[at] + inside * rest[some]
        source = np.concatenate([rows, some])
        none = np.concatenate([np.zeros(len(rows), bool), streamed])
        lists = batch["digests"]
        starts = np.asarray(lists.offsets)[:-1] - lists.offsets[0].as_py() if len(lists) else np.zeros(0, np.int64)
        digests = np.asarray(lists.flatten())
        which = np.concatenate([starts[rows] + number, starts[some] + n_full[some]])
        return pa.RecordBatch.from_arrays([
            batch["doc_id"].take(pa.array(source)),
            pa.array(np.concatenate([number * capacity, n_full[some] * capacity]), pa.int64()),
            pa.array(np.concatenate([np.full(len(rows), capacity), rest[some]]), pa.int64()),
            pa.array(digests[which], pa.int64()),
            pa.array(column["doc_tokens"][source], pa.int64()),
            pa.array(np.concatenate([full_sequence, sequence]), pa.int64(), mask=none),
            pa.array(np.concatenate([np.zeros(len(rows), np.int64), offset]), pa.int64(), mask=none),
            pa.array(np.concatenate([np.zeros(len(rows), np.int64), stream]), pa.int64(), mask=~none),
            pa.array(column["task"][source], pa.int32()),
            pa.array(column["nth"][source], pa.int64()),
        ], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "stream", "task", "nth"])

    return map_texts(ranked, schema, lambda: handle)


def cut_documents(material: DataFrame, plan: Plan) -> DataFrame:
    """The parts of the documents that lie in the stream, with digests from their ids."""
    kind = material.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

    def handle(batch):
        source, rows = [], []
        for at, (tokens, length, ids, stream) in enumerate(zip(*(batch[name].to_pylist() for name in ("doc_tokens", "length", "ids", "stream")))):
            ids = _wide(ids, length)
            for begin, size, sequence, offset in plan.cut(stream, length):
                source.append(at)
                rows.append((tokens - length + begin, size, zlib.crc32(ids[4 * begin:4 * (begin + size)]), tokens, sequence, offset))
        columns = list(zip(*rows)) if rows else [()] * 6
        return pa.RecordBatch.from_arrays(
            [batch["doc_id"].take(pa.array(source, pa.int64())), *[pa.array(c, pa.int64()) for c in columns]],
            ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return map_texts(material.select("doc_id", "doc_tokens", "length", "ids", "stream"), schema, lambda: handle)
