"""License scan: exact phrases, and a fuzzy search for short notices.

A text is reduced to its lower-cased words joined by single spaces. A notice that may differ in k
characters is split into k + 1 parts; at least one part of any place with at most k edits is
unharmed, so an Aho-Corasick search for all parts locates every candidate. Around a candidate,
twice as many parts are looked for, of which k + 2 must stand there; then the regex library's
bounded-error matching verifies the edits and gives the span.

Defined cases: null text is empty: no words, no places, score 0. A phrase that stands many times
counts at every place. Whole texts are searched, whatever their length; each row stands for itself,
so copies and ties need nothing special, and other columns are not read.
"""

from bisect import bisect_left
from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from kinweave.llm.tables import as_bytes, map_texts

# A word is a run of ASCII letters and digits and of characters beyond ASCII.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


PART = 9


@dataclass(frozen=True)
class Notice:
    """A short notice: its label, its words in lower case, and the edits (characters) it may be off.

    One edit in PART characters by default, so that every part is long enough to be rare in prose.
    """
    label: str
    words: str
    allowed: int | None = None

    @property
    def edits(self) -> int:
        return len(self.words) // PART - 1 if self.allowed is None else self.allowed


# The exact phrases and their labels.
PHRASES = (
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
)

NOTICES = (
    Notice("agpl", "gnu affero general public license"),
    Notice("apache", "licensed under the apache license version 2 0"),
    Notice("apache", "you may not use this file except in compliance with the license"),
    Notice("artistic", "licensed under the artistic license"),
    Notice("boost", "distributed under the boost software license"),
    Notice("bsd", "redistribution and use in source and binary forms with or without modification"),
    Notice("bsd", "neither the name of the copyright holder nor the names of its contributors"),
    Notice("cc-by-nc", "licensed under cc by nc 4 0"),
    Notice("cc", "licensed under a creative commons"),
    Notice("epl", "under the terms of the eclipse public license"),
    Notice("gpl", "licensed under the gnu general public license"),
    Notice("gpl", "you can redistribute it and or modify it under the terms of the gnu"),
    Notice("isc", "permission to use copy modify and or distribute this software for any purpose"),
    Notice("lgpl", "gnu lesser general public license"),
    Notice("mit", "released under the mit license"),
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    Notice("mpl", "subject to the terms of the mozilla public license"),
    Notice("proprietary", "all rights reserved no part of this"),
    Notice("unlicense", "this is free and unencumbered software released into the public domain"),
)

PLACES = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int32())]))


def split_evenly(text: str, parts: int) -> list[tuple[int, str]]:
    """(start, part) of a text cut into parts of about equal length."""
    cuts = [part * len(text) // parts for part in range(parts + 1)]
    return [(low, text[low:high]) for low, high in zip(cuts, cuts[1:])]


class Scanner:
    def __init__(self, phrases: Sequence[tuple[str, str]], notices: Sequence[Notice]):
        import ahocorasick
        import regex

        self.phrases = [(f" {phrase} ".encode(), label) for phrase, label in phrases]
        self.notices = notices
        # BESTMATCH: of the places with at most that many edits the one with fewest
        self.patterns = [
            regex.compile(f"(?b)(?:{regex.escape(n.words, literal_spaces=True)}){{e<={n.edits}}}") for n in notices
        ]
        seeds: dict[str, list[tuple[int, int]]] = {}
        for number, notice in enumerate(notices):
            for start, part in split_evenly(notice.words, notice.edits + 1):
                seeds.setdefault(part, []).append((number, start))
        self.halves = [[half for _, half in split_evenly(n.words, 2 * (n.edits + 1))] for n in notices]
        self.seeds = ahocorasick.Automaton()
        for seed, uses in seeds.items():
            self.seeds.add_word(seed, (len(seed), uses))
        self.seeds.make_automaton()

    def exact(self, joined: bytes) -> list[tuple[int, str]]:
        """(first word, label) of every place of every phrase; ``joined`` has a space at both ends."""
        found = []
        for phrase, label in self.phrases:
            at, counted, word = joined.find(phrase), 0, 0
            while at >= 0:
                word += joined.count(b" ", counted, at)
                counted = at
                found.append((word, label))
                at = joined.find(phrase, at + 1)
        return found

    def fuzzy(self, text: str) -> list[tuple[str, int, int, int]]:
        """(label, start, end, edits) of the notices in the joined words; places of one notice do not overlap."""
        windows: dict[int, set[tuple[int, int]]] = {}
        for end, (length, uses) in self.seeds.iter(text):
            for number, offset in uses:
                notice = self.notices[number]
                start = end - length + 1 - offset
                low, high = max(0, start - notice.edits), start + len(notice.words) + notice.edits
                window = text[low:high]
                if sum(half in window for half in self.halves[number]) < notice.edits + 2:
                    continue
                windows.setdefault(number, set()).add((low, min(high, len(text))))
        found = []
        for number, spans in windows.items():
            notice, pattern = self.notices[number], self.patterns[number]
            # each window by itself: in a longer one a better place would hide a weaker one before it
            places = {(sum(match.fuzzy_counts), match.start(), match.end())
                      for low, high in spans for match in pattern.finditer(text, low, high)}
            kept: list[tuple[int, int, int]] = []
            for edits, start, end in sorted(places):
                at = bisect_left(kept, (start,))
                if (at == len(kept) or end <= kept[at][0]) and (not at or kept[at - 1][1] <= start):
                    kept.insert(at, (start, end, edits))
            found += [(notice.label, *place) for place in kept]
        return found

@lru_cache(maxsize=4)
def scanner(phrases: tuple, notices: tuple) -> Scanner:
    return Scanner(phrases, notices)


def scan_documents(documents: DataFrame, phrases: Sequence[tuple[str, str]] = PHRASES,
                   notices: Sequence[Notice] = NOTICES) -> DataFrame:
    """Per document: doc_id, n_words, exact (word places and labels) and fuzzy (spans in the joined words, edits, label).

    ``score`` is 1 with an exact place, else 1 - edits / length of the best fuzzy place, else 0.
    """
    phrases, notices = tuple(phrases), tuple(notices)

    def start():
        scan = scanner(phrases, notices)

        def handle(batch):
            columns = [[] for _ in range(8)]
            for text in as_bytes(batch["text"]):
                words = text.translate(WORD_BYTES).split(b" ")
                words = [word for word in words if word]
                joined = b" ".join(words)
                exact = scan.exact(b" " + joined + b" ")
                fuzzy = scan.fuzzy(joined.decode())
                base = {label for _, label in exact}
                best = max((1 - edits / (end - begin) for _, begin, end, edits in fuzzy if end > begin), default=0.0)
                row = (len(words), len(exact), min((w for w, _ in exact), default=None),
                       max((w for w, _ in exact), default=None), ",".join(sorted(base)),
                       ",".join(sorted(base | {label for label, *_ in fuzzy})),
                       1.0 if exact else max(0.0, best),
                       [{"label": label, "start": begin, "end": end, "edits": edits}
                        for label, begin, end, edits in sorted(fuzzy, key=lambda place: place[1:])])
                for column, value in zip(columns, row):
                    column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), PLACES)
            arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds)]
            return pa.RecordBatch.from_arrays([batch["doc_id"], *arrays], names)
        return handle

    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "notices"]
    schema = (
        f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, n_words long, n_base long, first_word long, "
        "last_word long, base_labels string, labels string, score double, "
        "notices array<struct<label string, start long, end long, edits int>>"
    )
    return map_texts(documents.select("doc_id", "text"), schema, start)
