"""Toxicity: a learned lexicon, matched with Levenshtein automata on a trie, weighed by context.

Learning. A bounded sample of ``max_sample`` labelled documents (hash-picked, copies of a whole text counted
once in a class; the model's ``used`` says how many rows that leaves) gives the lexicon: whole words and word beginnings that are much more frequent in toxic documents.
A logistic regression on the weighted number of matches of each term gives the weights.

Matching. Every distinct word of a batch is looked up once. Beginnings must match exactly; a whole
word of MIN_FUZZY letters or more may be off by one letter: the word's Levenshtein automaton (its
states as bits, one row per number of errors) walks the lexicon's trie, and branches end where no
state is left. Misspelled forms that also occur in clean sampled documents are words of their own
and do not count.

Context. A match inside quotation marks or after a word of report weighs QUOTED, one next to a
word of address ADDRESSED; others weigh 1, misspelled ones FUZZY times that.

Defined cases: null and empty texts have no match and get the score of the intercept. With no toxic
or no clean label the score is 0 for all. Repeated label rows of a document count once, as toxic
if any is; null labels and null ids teach nothing. Whole texts are read; columns other than doc_id, text and
the label's are not.
"""

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from kinweave.llm.tables import drawn, held_out, map_texts, written

MAX_SAMPLE = 6000
MAX_TERMS = 300
LEAST_SUPPORT, LEAST_SURE = 4, 4.0
STEM_LENGTHS = range(4, 9)
MIN_FUZZY = 5
FUZZY, QUOTED, ADDRESSED = 0.8, 0.3, 1.3
MOST_COUNTED = 5.0
WINDOW = 4
COUNTED_ROWS = 100  # texts whose terms are counted at a time; their table is the largest a task holds
EDGES = "\"'“”„«»‘’‚.,;:!?()[]{}<>|*_-–—…/\\`~#=+"
QUOTES = "\"“”„«»"
# Words of report and of address, in the languages of the corpus.
REPORTING = frozenset("said says called wrote word term phrase quote quoted sagte nannte wort dit mot dijo palabra".split())
ADDRESSING = frozenset("you your yours youre du dich dein ihr tu toi ton vous usted tus".split())


class Node:
    __slots__ = ("next", "term")

    def __init__(self):
        self.next: dict[str, Node] = {}
        self.term = -1


class Lexicon:
    """Whole words in a trie, word beginnings in a table; both map to positions in ``terms``."""

    def __init__(self, terms: Sequence[str], not_misspelled: frozenset[str] = frozenset()):
        self.root = Node()
        self.words: dict[str, int] = {}
        self.stems: dict[str, int] = {}
        self.not_misspelled = not_misspelled
        for number, term in enumerate(terms):
            if not term.endswith("$"):
                self.stems[term] = number
                continue
            self.words[term[:-1]] = number
            if len(term) > MIN_FUZZY:
                node = self.root
                for letter in term[:-1]:
                    node = node.next.setdefault(letter, Node())
                node.term = number
        fuzzy = [word for word in self.words if len(word) >= MIN_FUZZY]
        self.lengths = {len(word) + d for word in fuzzy for d in (-1, 0, 1)}
        # one edit leaves the first or the second half of a word unharmed
        self.heads = {word[:2] for word in fuzzy}
        self.tails = {word[-2:] for word in fuzzy}

    def find(self, word: str) -> list[tuple[int, float]]:
        """(term, weight) of every term the word matches."""
        found = [(self.stems[word[:n]], 1.0) for n in STEM_LENGTHS if n < len(word) and word[:n] in self.stems]
        whole = self.words.get(word)
        if whole is not None:
            found.append((whole, 1.0))
        elif (len(word) in self.lengths and (word[:2] in self.heads or word[-2:] in self.tails)
              and word not in self.not_misspelled):
            found += [(term, FUZZY) for term in self.misspelled(word)]
        return found

    def misspelled(self, word: str) -> list[int]:
        """Terms at a Levenshtein distance of one from the word."""
        letters: dict[str, int] = {}
        for at, letter in enumerate(word):
            letters[letter] = letters.get(letter, 0) | 1 << at
        end, found = 1 << len(word), []
        inside = (end << 1) - 1
        waiting = [(self.root, 1, 0b11)]
        while waiting:
            node, none, one = waiting.pop()
            if node.term >= 0 and one & end:
                found.append(node.term)
            for letter, child in node.next.items():
                same = letters.get(letter, 0)
                none_next = (none & same) << 1
                # match; substitution and insertion from no error; deletion after this step
                one_next = ((one & same) << 1 | none << 1 | none | none_next << 1) & inside
                if none_next | one_next:
                    waiting.append((child, none_next, one_next))
        return sorted(found)


@dataclass(frozen=True)
class ToxicityModel:
    terms: tuple[str, ...]
    weights: np.ndarray
    rates: np.ndarray
    intercept: float
    not_misspelled: frozenset[str] = frozenset()
    constant: float | None = None
    used: tuple[int, int] = (0, 0)  # clean and toxic rows it was learned from
    lexicon: Lexicon = field(default=None, compare=False, repr=False)

    def __post_init__(self):
        object.__setattr__(self, "lexicon", Lexicon(self.terms, self.not_misspelled))

    def __reduce__(self):
        return ToxicityModel, (self.terms, self.weights, self.rates, self.intercept, self.not_misspelled, self.constant, self.used)

    def score(self, texts: pa.Array) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        hits, n_words = matches(texts, self.lexicon)
        logits = np.full(len(texts), self.intercept)
        for row, found in hits.items():
            x = damped(found, int(n_words[row]), self.rates)
            logits[row] += sum(self.weights[term] * value for term, value in x.items())
        return 1 / (1 + np.exp(-np.clip(logits, -30, 30)))


def damped(found: dict[int, float], n_words: int, rates: np.ndarray) -> dict[int, float]:
    """Matches per term, weighed down by how many a clean text of that length would have."""
    return {term: min(n, MOST_COUNTED) / (1 + rates[term] * n_words) for term, n in found.items()}


def split_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Bounds of each text among all words, the words as places in a list, and that list of distinct words."""
    lower = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    words = pc.utf8_split_whitespace(lower)
    bounds = np.asarray(words.offsets)
    coded = words.values.dictionary_encode()
    return bounds, np.asarray(coded.indices), coded.dictionary.to_pylist()


def matches(texts: pa.Array, lexicon: Lexicon) -> tuple[dict[int, dict[int, float]], np.ndarray]:
    """For each text with matches the weighted number of matches of each term; and all texts' word counts."""
    bounds, places, distinct = split_words(texts)
    found = {}
    for number, word in enumerate(distinct):
        terms = lexicon.find(word.strip(EDGES))
        if terms:
            found[number] = terms
    hit = np.zeros(len(distinct) + 1, bool)
    hit[list(found)] = True
    hits: dict[int, dict[int, float]] = {}
    for at in np.flatnonzero(hit[places]).tolist():
        row = int(np.searchsorted(bounds, at, side="right")) - 1
        low, high = int(bounds[row]), int(bounds[row + 1])
        context = context_weight([distinct[p] for p in places[max(low, at - WINDOW):at]], distinct[places[at]],
                                 [distinct[p] for p in places[at + 1:min(high, at + 1 + WINDOW)]])
        counts = hits.setdefault(row, {})
        for term, weight in found[int(places[at])]:
            counts[term] = counts.get(term, 0.0) + weight * context
    return hits, np.diff(bounds)


def context_weight(before: list[str], word: str, after: list[str]) -> float:
    opened = any(c in QUOTES for c in word[:1]) or any(w[:1] in QUOTES and w[-1:] not in QUOTES for w in before if w)
    closed = any(c in QUOTES for c in word.rstrip(".,;:!?")[-1:]) or any(
        w.rstrip(".,;:!?")[-1:] in QUOTES and w[:1] not in QUOTES for w in after if w.rstrip(".,;:!?"))
    if opened and closed or any(w.strip(EDGES) in REPORTING for w in before[-2:]):
        return QUOTED
    if any(w.strip(EDGES) in ADDRESSING for w in (*before[-2:], *after[:2])):
        return ADDRESSED
    return 1.0


def units(words: set[str]) -> set[str]:
    """What a term may be: a whole word, marked by $, or a beginning with at least a letter after it."""
    found = set()
    for word in words:
        if len(word) >= 4 and word.isalpha():
            found.add(f"{word}$")
            found.update(word[:n] for n in STEM_LENGTHS if n < len(word))
    return found


def _rows(batch: pa.RecordBatch):
    """(toxic, word counts) of each text of a batch."""
    bounds, places, distinct = split_words(batch["text"])
    stripped = [word.strip(EDGES) for word in distinct]
    for toxic, low, high in zip(batch["toxic"].to_pylist(), bounds, bounds[1:]):
        yield toxic, Counter(stripped[p] for p in places[low:high])


def fit(documents: DataFrame, labels: DataFrame, max_sample: int = MAX_SAMPLE, max_terms: int = MAX_TERMS,
        seed: int = 7) -> ToxicityModel:
    """Learn from labelled documents outside the held-out fold."""
    marked = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    marked = marked.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    sizes = {row["toxic"]: row["count"] for row in marked.groupBy("toxic").count().collect()}
    if not sizes.get(0) or not sizes.get(1):
        return ToxicityModel((), np.zeros(0), np.zeros(0), 0.0, constant=0.0)
    # half of the sample may be toxic; a class that is rarer than that is taken whole
    pick = [drawn(max_sample / 2 / sizes[toxic], F.col("doc_id"), F.lit(seed)) for toxic in (0, 1)]
    picked = F.broadcast(marked.where(F.when(F.col("toxic") == 1, pick[1]).otherwise(pick[0])))  # about max_sample rows of two numbers
    # 128 bits of the whole text: only true copies fall together
    text = F.coalesce("text", F.lit(""))
    digest = [F.xxhash64(text).alias("digest"), F.xxhash64(F.lit(seed), text).alias("digest_2")]
    taught = documents.select("doc_id", "text").join(picked, "doc_id").select("text", "toxic", *digest)
    sample = written(taught.dropDuplicates(["digest", "digest_2", "toxic"]).select("text", "toxic"), "toxicity-sample")
    n_toxic = sample.where("toxic = 1").count()
    n_clean = sample.count() - n_toxic
    if not n_toxic or not n_clean:
        return ToxicityModel((), np.zeros(0), np.zeros(0), 0.0, constant=0.0)

    def count_units(only: frozenset[str] | None):
        def start():
            def handle(batch):
                counts: Counter = Counter()
                for _, words in _rows(batch):
                    there = units(set(words))
                    counts.update(there if only is None else there & only)
                return pa.RecordBatch.from_arrays(
                    [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["unit", "n"])
            return handle
        return start

    def totals(rows: DataFrame, only: frozenset[str] | None, least: int) -> dict[str, int]:
        counted = map_texts(rows, "unit string, n long", count_units(only), COUNTED_ROWS).groupBy("unit").agg(F.sum("n").alias("n"))
        return {row["unit"]: row["n"] for row in counted.where(F.col("n") >= least).collect()}

    least = max(LEAST_SUPPORT, n_toxic // 100)
    in_toxic = totals(sample.where("toxic = 1"), None, least)
    in_clean = totals(sample.where("toxic = 0"), frozenset(in_toxic), 1)
    terms = choose_terms(in_toxic, in_clean, n_toxic, n_clean, max_terms)
    # first the forms of all clean documents, then the matches with all of them: no batch has its own
    not_misspelled = clean_forms(sample, terms)
    return replace(train(terms, sample_matches(sample, terms, not_misspelled), not_misspelled), used=(n_clean, n_toxic))


def choose_terms(in_toxic: dict[str, int], in_clean: dict[str, int], n_toxic: int, n_clean: int,
                 max_terms: int) -> tuple[str, ...]:
    """The terms whose share among toxic documents most surely exceeds that among clean ones; one of each nested run."""
    scored = {}
    for unit, n in in_toxic.items():
        toxic, clean = (n + 0.5) / (n_toxic + 1), (in_clean.get(unit, 0) + 0.5) / (n_clean + 1)
        pooled = (n + in_clean.get(unit, 0) + 1) / (n_toxic + n_clean + 2)
        sure = (toxic - clean) / np.sqrt(pooled * (1 - pooled) * (1 / n_toxic + 1 / n_clean))
        if toxic >= 3 * clean and sure >= LEAST_SURE:
            scored[unit] = sure
    kept: list[str] = []
    for unit in sorted(scored, key=lambda u: (-len(u), u)):
        # a beginning that says no more than a longer term is that term
        longer = [k for k in kept if k.startswith(unit)]
        if not any(in_toxic[k] >= 0.9 * in_toxic[unit] for k in longer):
            kept.append(unit)
    return tuple(sorted(sorted(kept, key=lambda u: (-scored[u], u))[:max_terms]))


def clean_forms(sample: DataFrame, terms: tuple[str, ...]) -> frozenset[str]:
    """Words of clean sampled documents that the automata take for misspelled terms."""
    lexicon = Lexicon(terms)

    def start():
        def handle(batch):
            words = {word for _, counts in _rows(batch) for word in counts if word not in lexicon.words}
            return pa.RecordBatch.from_arrays([pa.array(sorted(
                word for word in words if any(w == FUZZY for _, w in lexicon.find(word))), pa.string())], ["form"])
        return handle

    rows = map_texts(sample.where("toxic = 0"), "form string", start).distinct().collect()
    return frozenset(row["form"] for row in rows)


def sample_matches(sample: DataFrame, terms: tuple[str, ...], not_misspelled: frozenset[str]) -> list:
    """(toxic, words, matched terms, their counts) of each sampled document, in an order of their own."""
    lexicon = Lexicon(terms, not_misspelled)

    def start():
        def handle(batch):
            hits, n_words = matches(batch["text"], lexicon)
            found = [sorted(hits.get(row, {}).items()) for row in range(batch.num_rows)]
            return pa.RecordBatch.from_arrays(
                [batch["toxic"], pa.array(n_words, pa.int64()), pa.array([[t for t, _ in x] for x in found], pa.list_(pa.int32())),
                 pa.array([[n for _, n in x] for x in found], pa.list_(pa.float64()))], ["toxic", "n_words", "terms", "counts"])
        return handle

    rows = map_texts(sample, "toxic int, n_words long, terms array<int>, counts array<double>", start).collect()
    # sums of floating numbers depend on their order, so it must not depend on partitions
    return sorted(rows, key=lambda row: (row["toxic"], row["n_words"], row["terms"], row["counts"]))


def train(terms: tuple[str, ...], rows: list, not_misspelled: frozenset[str], steps: int = 600,
          rate: float = 0.1, decay: float = 1e-3) -> ToxicityModel:
    """Logistic regression with weights of at least 0, so that a term never speaks for a clean text."""
    clean = [row for row in rows if not row["toxic"]]
    rates = np.full(len(terms), 0.0)
    for row in clean:
        for term, n in zip(row["terms"], row["counts"]):
            rates[term] += n
    rates /= max(1, sum(row["n_words"] for row in clean))
    x = np.zeros((len(rows), len(terms)))
    for at, row in enumerate(rows):
        for term, value in damped(dict(zip(row["terms"], row["counts"])), row["n_words"], rates).items():
            x[at, term] = value
    y = np.array([row["toxic"] for row in rows], float)
    weights, intercept = np.full(len(terms), 1.0), -2.0
    # each class has half of the weight
    importance = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
    moment, square = np.zeros(len(terms) + 1), np.zeros(len(terms) + 1)
    for step in range(1, steps + 1):
        error = importance * (1 / (1 + np.exp(-np.clip(x @ weights + intercept, -30, 30))) - y)
        gradient = np.append(x.T @ error + decay * weights, error.sum())
        moment = 0.9 * moment + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient ** 2
        change = rate * (moment / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.999 ** step)) + 1e-9)
        weights = np.maximum(0, weights - change[:-1])
        intercept = min(-0.5, intercept - change[-1])
    return ToxicityModel(terms, weights, rates, float(intercept), not_misspelled)


def score_documents(documents: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id and score (0 to 1) of every whole text."""
    def start():
        def handle(batch):
            return pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(model.score(batch["text"]), pa.float64())], ["doc_id", "score"])
        return handle

    kind = documents.schema["doc_id"].dataType.simpleString()
    return map_texts(documents.select("doc_id", "text"), f"doc_id {kind}, score double", start)


def keep_clean(documents: DataFrame, model: ToxicityModel, threshold: float = 0.5) -> DataFrame:
    """The documents, as they are, with a score below the threshold."""
    def start():
        def handle(batch):
            return batch.filter(pa.array(model.score(batch["text"]) < threshold))
        return handle

    return map_texts(documents, documents.schema, start)
