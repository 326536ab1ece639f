import random
import re

from kinweave.llm import licenses
from rows import AWKWARD, LONG

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_scan(text):
    """Words and exact places, word by word."""
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lowered)
    places = []
    for phrase, label in licenses.PHRASES:
        phrase = phrase.split()
        places += [(at, label) for at in range(len(words)) if words[at:at + len(phrase)] == phrase]
    starts = [at for at, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def edits(a, b):
    """Levenshtein distance."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, before[j] + 1, before[j - 1] + (x != y)))
    return row[-1]


def test_base_columns(awkward, documents, nothing):
    tricky = ["MIT license mit-license MIT  LICENSE mitlicense", "apache license " * 3000, "General Public licensé general public license"]
    rows = [(100 + n, text, None, None, None) for n, text in enumerate(tricky)]
    for df, given in ((awkward, AWKWARD), (documents(rows), rows)):
        found = sorted((str(tuple(row)[:6]) for row in licenses.scan_documents(df).collect()))
        assert found == sorted(str((doc_id, *plain_scan(text))) for doc_id, text, *_ in given)
    assert licenses.scan_documents(nothing).collect() == []


def test_every_notice_within_its_edits_is_found_with_its_span():
    rng = random.Random(6)
    scan = licenses.scanner(tuple(licenses.PHRASES), licenses.NOTICES)
    for notice in licenses.NOTICES:
        for _ in range(20):
            changed = list(notice.words)
            for _ in range(rng.randint(0, notice.edits)):
                at, kind = rng.randrange(len(changed)), rng.randrange(3)
                if kind == 0:
                    changed[at] = rng.choice("abcdefgh ")
                elif kind == 1:
                    del changed[at]
                else:
                    changed.insert(at, rng.choice("abcdefgh "))
            text = "zz qq " + "".join(changed) + " kk vv"
            found = [place for place in scan.fuzzy(text) if place[0] == notice.label]
            assert found
            for label, start, end, n in found:
                best = min(edits(other.words, text[start:end]) for other in licenses.NOTICES if other.label == label)
                assert best <= n <= max(other.edits for other in licenses.NOTICES if other.label == label)


def test_clean_text_has_no_notice(documents):
    row = licenses.scan_documents(documents([(1, LONG, None, None, None)])).first()
    assert (row.labels, row.score, row.notices) == ("", 0.0, [])


def test_labels_of_the_method_are_added(documents):
    text = "Permision is hereby granted, free of charge, to any person obtaning a copy. Apache License."
    row = licenses.scan_documents(documents([(1, text, None, None, None)])).first()
    assert (row.base_labels, row.labels, row.score) == ("apache", "apache,mit", 1.0)
    row = licenses.scan_documents(documents([(1, text[:-16], None, None, None)])).first()
    assert row.labels == "mit" and 0.9 < row.score < 1


def test_a_weaker_notice_close_before_a_better_one_is_found():
    scan = licenses.scanner(tuple(licenses.PHRASES), licenses.NOTICES)
    notice = next(n for n in licenses.NOTICES if n.label == "lgpl")
    weaker = notice.words.replace("lesser", "leser").replace("public", "pubic")
    for first, second in ((weaker, notice.words), (notice.words, weaker), (weaker, weaker)):
        text = f"zz {first} qq {second} kk"
        found = sorted(place[1:] for place in scan.fuzzy(text) if place[0] == "lgpl")
        assert len(found) == 2 and found[0][2] <= found[1][1]
        assert [n for _, _, n in found] == [2 * (first == weaker), 2 * (second == weaker)]
