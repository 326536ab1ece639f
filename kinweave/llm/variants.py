"""Spelling variants of words by one-edit neighbourhoods over a reduced alphabet.

Words are counted over the whole corpus: distinct words of a batch, with their numbers, leave the Python
worker, and Spark adds them up. Two words are near if they differ by one inserted, deleted
or replaced character.

Letters are hashed to a few symbols. One edit of a word is at most one edit of its reduced word, so near words
are found among words whose reduced words are equal or neighbours. Every reduced word is generated
with its neighbourhood, keyed by a 64-bit polynomial digest that prefix and suffix sums give for each
edit without building the string; the keys are joined with the reduced vocabulary, and the pairs
that meet are verified on their original strings. Each pair of reduced words meets once:
from the longer one by its deletions, from the one with the smaller symbol by its replacements (an insertion is a
deletion seen from the other side). The neighbourhoods so hold about symbols / 2 + 1 keys a
letter, and their size is that of the vocabulary's letters times a constant.

The number of symbols follows from the histogram of word lengths: the smallest at which a word is expected to
meet at most MEETINGS others that need verifying. More symbols only mean more keys and fewer meetings; no result
depends on it. Words of more than SHORT characters travel as digests and are looked up for the verification, so
a long word does not repeat its text with each key.

Forms: of a word's near words the most frequent one, if it is FACTOR times as frequent. A chain of forms
grows by that factor with each step, so its length is at most the logarithm of the largest count;
roots are found by doubling.

Defined cases: null text has no words, a null id counts as empty text. Repeated rows are documents like others and count
each time. An empty table gives an empty result. Columns other than doc_id and text are not read.
"""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kinweave.llm.tables import map_texts, written

LEAST_LETTERS = 7
LEAST_COUNT = 2
FACTOR = 10
DROP_EVERY = 31
SHORT = 64
MEETINGS = 32
FEWEST, MOST = 4, 16
EVENNESS = 0.7  # letters are not equally frequent: k symbols tell words apart about as well as 0.7 k even ones
BLOCK = 1 << 20
WORDS_A_TASK = 50_000
BASE, STEP = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F  # odd 64-bit numbers of the digest


def letters() -> bytes:
    """For every Latin-1 character the letter it counts as: A-Z in lower case, a-z and U+00C0 to U+00FF as they are, else 0."""
    table = bytearray(256)
    for code in (*range(0x61, 0x7B), *range(0xC0, 0x100)):
        table[code] = code
    for code in range(0x41, 0x5B):
        table[code] = code + 0x20
    return bytes(table)


def count_words(documents: DataFrame) -> DataFrame:
    """(word, n) over all texts: runs of letters, some with a letter dropped, of at least LEAST_LETTERS letters."""
    table = letters()

    def handle(batch):
        texts = [(text or "").encode("latin-1", "replace") for text in batch["text"].to_pylist()]
        data = np.frombuffer(b"\0".join([*texts, b""]).translate(table), np.uint8)
        begins = np.cumsum([0, *(len(text) + 1 for text in texts)])[:-1]
        edges = np.flatnonzero(np.diff((data != 0).astype(np.int8), prepend=0, append=0))
        starts, ends = edges[::2], edges[1::2]
        long = ends - starts >= LEAST_LETTERS
        starts, ends = starts[long], ends[long]
        kept = np.zeros(len(data) + 1, np.int8)
        kept[starts] += 1
        kept[ends] -= 1
        runs = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [
            None, pa.py_buffer(np.append(0, np.cumsum(ends - starts)).astype(np.int64)),
            pa.py_buffer(data[np.cumsum(kept[:-1]) > 0].tobytes())]).dictionary_encode()
        words = [word.decode("latin-1") for word in runs.dictionary.to_pylist()]
        number = np.asarray(runs.indices).astype(np.int64)
        pairs, times = np.unique((np.searchsorted(begins, starts, "right") - 1) * max(len(words), 1) + number, return_counts=True)
        before = [zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode()) for doc_id in batch["doc_id"].to_pylist()]
        encoded = [word.encode() for word in words]
        docs, place = np.divmod(pairs, max(len(words), 1))
        digests = np.fromiter((zlib.crc32(encoded[w], before[d]) for d, w in zip(docs.tolist(), place.tolist())), np.int64, len(pairs))
        drops = digests % DROP_EVERY == 0
        whole = np.bincount(place[~drops], times[~drops], len(words)).astype(np.int64)
        found = Counter()
        for w, digest, n in zip(place[drops].tolist(), digests[drops].tolist(), times[drops].tolist()):
            word = words[w]
            if len(word) > LEAST_LETTERS:
                at = digest % len(word)
                found[word[:at] + word[at + 1:]] += n
        some = np.flatnonzero(whole).tolist()
        return pa.RecordBatch.from_arrays([
            pa.array([words[w] for w in some] + list(found), pa.string()),
            pa.array(whole[some].tolist() + list(found.values()), pa.int64())], ["word", "n"])

    counted = map_texts(documents.select("doc_id", "text"), "word string, n long", lambda: handle)
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def choose_symbols(words: DataFrame, meetings: int = MEETINGS) -> int:
    """The smallest number of symbols at which words are expected to meet ``meetings`` others each, from their lengths."""
    by_length = words.groupBy(F.length("word").cast("double").alias("l")).agg(F.count("*").cast("double").alias("c"))

    def expected(k):
        return F.sum(F.col("c") * F.col("c") * k * F.col("l") / F.pow(F.lit(EVENNESS * k), "l")).alias(str(k))

    row = by_length.agg(F.sum("c").alias("all"), *[expected(k) for k in range(FEWEST, MOST + 1)]).first()
    return next((k for k in range(FEWEST, MOST) if (row[str(k)] or 0) <= meetings * (row["all"] or 0)), MOST)


def reduce_letters(symbols: int) -> np.ndarray:
    """The symbol of every Latin-1 character: a multiplicative hash of its code."""
    return np.array([(code * BASE >> 32 & 0xFFFFFFFF) % symbols for code in range(256)], np.uint64)


def _by_length(words: list[str], symbols: int):
    """(rows, reduced words as a matrix) for the words of each length, in blocks of bounded size."""
    table = reduce_letters(symbols)
    places: dict[int, list[int]] = {}
    for at, word in enumerate(words):
        places.setdefault(len(word), []).append(at)
    for length, rows in places.items():
        step = max(1, BLOCK // ((symbols + 1) * length))
        for low in range(0, len(rows), step):
            part = rows[low:low + step]
            data = np.frombuffer("".join([words[at] for at in part]).encode("latin-1"), np.uint8)
            yield np.array(part), table[data].reshape(len(part), length)


def _powers(length: int) -> np.ndarray:
    return np.cumprod(np.append(np.ones(1, np.uint64), np.full(length, BASE, np.uint64)), dtype=np.uint64)


def reduced_keys(words: list[str], symbols: int) -> np.ndarray:
    """The digest of every reduced word."""
    keys = np.zeros(len(words), np.uint64)
    for rows, reduced in _by_length(words, symbols):
        length = reduced.shape[1]
        terms = (reduced + np.uint64(1)) * _powers(length)[:length]
        keys[rows] = terms.sum(axis=1, dtype=np.uint64) + np.uint64(length * STEP & 2 ** 64 - 1)
    return keys


def neighbour_keys(words: list[str], symbols: int):
    """(row, key, own) in blocks: a word's own key, and those of its reduced word less a symbol or with a larger symbol."""
    back = np.uint64(pow(BASE, -1, 2 ** 64))
    for rows, reduced in _by_length(words, symbols):
        length = reduced.shape[1]
        powers = _powers(length)
        at_length, at_shorter = (np.uint64(n * STEP & 2 ** 64 - 1) for n in (length, length - 1))
        before = np.zeros((len(rows), length + 1), np.uint64)
        np.cumsum((reduced + np.uint64(1)) * powers[:length], axis=1, dtype=np.uint64, out=before[:, 1:])
        total = before[:, -1]
        yield rows, total + at_length, True
        for low in range(0, length, BLOCK):
            part = slice(low, min(low + BLOCK, length))
            # of equal symbols in a row any one gives the same word
            first = np.ones((len(rows), part.stop - low), bool)
            inner = max(low, 1)
            first[:, inner - low:] = reduced[:, inner:part.stop] != reduced[:, inner - 1:part.stop - 1]
            shorter = before[:, part] + (total[:, None] - before[:, low + 1:part.stop + 1]) * back + at_shorter
            which = np.nonzero(first)
            yield rows[which[0]], shorter[which], False
            for more in range(1, symbols):
                which = np.nonzero(reduced[:, part] < np.uint64(symbols - more))
                yield rows[which[0]], total[which[0]] + np.uint64(more) * powers[part][which[1]] + at_length, False


def with_keys(words: DataFrame, symbols: int) -> DataFrame:
    """Add ``key``, the digest of the reduced word, to (word, n)."""
    def handle(batch):
        keys = reduced_keys(batch["word"].to_pylist(), symbols).view(np.int64)
        return pa.RecordBatch.from_arrays([batch["word"], batch["n"], pa.array(keys)], ["word", "n", "key"])

    return map_texts(words.select("word", "n"), "word string, n long, key long", lambda: handle, 20_000)


def neighbourhoods(words: DataFrame, symbols: int) -> DataFrame:
    """(key, own, name, n) for every reduced word within one edit of each word's; ``name`` is what the word travels as."""
    def run(batches):
        for batch in batches:
            for rows, keys, own in neighbour_keys(batch["word"].to_pylist(), symbols):
                for low in range(0, len(keys), 1 << 16):
                    taken = pa.array(rows[low:low + (1 << 16)])
                    yield pa.RecordBatch.from_arrays([
                        pa.array(keys[low:low + (1 << 16)].view(np.int64)), pa.array(np.full(len(taken), own)),
                        batch["name"].take(taken), batch["n"].take(taken)], ["key", "own", "name", "n"])

    name = F.when(F.length("word") > SHORT, F.concat(F.lit("#"), F.sha2("word", 256))).otherwise(F.col("word"))
    return words.select("word", name.alias("name"), "n").mapInArrow(run, "key long, own boolean, name string, n long")


def near_pairs(words: DataFrame, symbols: int) -> DataFrame:
    """(a, b, n_a, n_b): every pair of near words of the written table (word, n, key) once."""
    others = words.select("key", F.col("word").alias("b"), F.col("n").alias("n_b"))
    # a word becomes some thirty rows, so a small table is work for many tasks
    tasks = max(1, math.ceil(words.count() / WORDS_A_TASK))
    short = words.where(F.length("word") <= SHORT).repartition(tasks)
    long = words.where(F.length("word") > SHORT)
    met = neighbourhoods(short, symbols).withColumnsRenamed({"name": "a", "n": "n_a"}).join(others.hint("shuffle_hash"), "key")
    met_long = neighbourhoods(long, symbols).withColumnRenamed("n", "n_a").join(others, "key").join(
        long.select(F.concat(F.lit("#"), F.sha2("word", 256)).alias("name"), F.col("word").alias("a")), "name")
    # words of the same reduced word meet from both sides
    once = ~F.col("own") | (F.col("a") < F.col("b"))
    near = F.levenshtein("a", "b", 1) == 1
    return met.select("own", "a", "b", "n_a", "n_b").unionByName(met_long.select("own", "a", "b", "n_a", "n_b")).where(
        once & near).select("a", "b", "n_a", "n_b")


def group_variants(documents: DataFrame, symbols: int | None = None) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word with at least LEAST_COUNT occurrences."""
    counted = written(count_words(documents).where(F.col("n") >= LEAST_COUNT), "variant-words")
    symbols = symbols or choose_symbols(counted)
    words = written(with_keys(counted, symbols), "variant-keys")
    pairs = written(near_pairs(words, symbols), "variant-pairs")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("word")).groupBy("word").agg(F.count("*").alias("n_near"))
    formed = written(forms(pairs), "variant-forms")
    rooted = roots(formed, counted)
    found = counted.join(ends, "word", "left").join(formed, "word", "left").join(rooted, "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")


def forms(pairs: DataFrame) -> DataFrame:
    """(word, form, form_n) of every word with a near word at least FACTOR times as frequent."""
    a, b, n_a, n_b = map(F.col, ("a", "b", "n_a", "n_b"))
    rising = pairs.where((n_b >= FACTOR * n_a) | (n_a >= FACTOR * n_b)).select(
        F.when(n_a < n_b, a).otherwise(b).alias("word"), F.when(n_a < n_b, b).otherwise(a).alias("near"),
        F.greatest(n_a, n_b).alias("n"))
    best = rising.groupBy("word").agg(F.min(F.struct((-F.col("n")).alias("n"), "near")).alias("best"))
    return best.select("word", F.col("best.near").alias("form"), (-F.col("best.n")).alias("form_n"))


def roots(formed: DataFrame, words: DataFrame) -> DataFrame:
    """(word, root) of every word with a form: each round doubles the steps along the chains."""
    top = words.agg(F.max("n")).first()[0] or 1
    steps = max(0, math.floor(math.log(top / LEAST_COUNT, FACTOR) + 1e-9)) if top > LEAST_COUNT else 0
    reached = formed.select("word", F.col("form").alias("root"))
    for number in range(math.ceil(math.log2(steps)) if steps > 1 else 0):
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("further"))
        reached = written(reached.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root")),
                          f"variant-roots-{number}")
    return reached
