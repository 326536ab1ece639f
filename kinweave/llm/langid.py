"""Language identification: averaged hashed subword embeddings under a linear softmax.

Subwords are the runs of 1 to MAX_GRAM letters of a word, with the blank before or behind it as a
character; each is hashed into a bucket with an embedding. A text is the mean of the embeddings of
all its subwords. Embeddings and softmax are trained by stochastic gradient descent in numpy on a
bounded sample: about ``per_language`` labelled documents of each language, and MAX_SAMPLE in all, picked
by a hash of the row, whole texts. Executors send the sample as bucket shares, so its size does not depend on how
long texts are. One sampled document in five is not trained on but calibrates the model: a
temperature for the probabilities, and the probability below which a prediction is rejected, between those of
right predictions and those of wrong ones, of renamed subwords and of random letters.

Defined cases: null text and text without a letter is ``und`` with score 0, and so is every text
if no document is labelled. Whole texts are read, whatever their length. Repeated rows count as
often as they occur; equal scores go to the language that sorts first. Columns other than doc_id,
text and lang are not read.
"""

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kinweave.llm.tables import as_texts, held_out, map_texts

BUCKETS = 1 << 12
MAX_GRAM = 4
DIMENSIONS = 16
PER_LANGUAGE, MAX_SAMPLE = 800, 8000
SEGMENT = 1 << 19
UNKNOWN = "und"
BLANK = 32

_letters: list[np.ndarray] = []


def letter_table() -> np.ndarray:
    """For every code point, whether it is a letter."""
    if not _letters:
        points = range(sys.maxunicode + 1)
        _letters.append(np.fromiter((chr(point).isalpha() for point in points), bool, len(points)))
    return _letters[0]


def code_points(text: str) -> np.ndarray:
    """Lower-cased letters with a blank for everything else, and one at both ends."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    framed = np.full(len(points) + 2, BLANK, np.uint32)
    letters = letter_table()[points]
    framed[1:-1][letters] = points[letters]
    return framed


def segments(framed: np.ndarray):
    """Parts of about SEGMENT code points that begin and end with a blank and lose no subword."""
    start = 0
    while start < len(framed) - 1:
        end = start + SEGMENT
        blanks = np.flatnonzero(framed[end:] == BLANK) if end < len(framed) else ()
        end = end + blanks[0] + 1 if len(blanks) else len(framed)
        yield framed[start:end]
        start = end - 1


def buckets_of(framed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and start of every subword: letters of one word, with a blank at either end of it."""
    found, starts = [], []
    blank = framed == BLANK
    place = np.arange(len(framed))
    state = np.zeros(len(framed), np.uint32)
    inner = np.ones(len(framed), bool)
    for length in range(1, MAX_GRAM + 1):
        n = len(framed) - length + 1
        if n <= 0:
            break
        state = (state[:n] ^ framed[length - 1:]) * np.uint32(0x01000193)
        if length >= 3:
            inner = inner[:n] & ~blank[length - 2:length - 2 + n]
        keep = ~blank if length == 1 else inner[:n] if length > 2 else ~(blank[:n] & blank[1:])
        mixed = state[keep] ^ (state[keep] >> np.uint32(15))
        found.append((mixed * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - BUCKETS.bit_length() + 1))
        starts.append(place[:n][keep])
    return np.concatenate(found), np.concatenate(starts)


def shares(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text and the share of its subwords in each."""
    total = np.zeros(BUCKETS)
    for part in segments(code_points(text)):
        total += np.bincount(buckets_of(part)[0], minlength=BUCKETS)
    used = np.flatnonzero(total)
    return used.astype(np.uint16), (total[used] / max(1, total.sum())).astype(np.float32)


@dataclass(frozen=True)
class LanguageModel:
    """``table[bucket]`` holds the logits of one subword; a text's logits are their mean plus ``bias``."""
    languages: tuple[str, ...]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    reject_below: float

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        sums, counts = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts))
        waiting, size = [], 0
        for row, text in enumerate(texts):
            for part in segments(code_points(text)):
                waiting.append((row, part))
                size += len(part)
                if size > SEGMENT:
                    self._add(waiting, sums, counts)
                    waiting, size = [], 0
        self._add(waiting, sums, counts)
        known = (counts > 0) & bool(self.languages)
        if not known.any():
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        logits = (sums / np.maximum(counts, 1)[:, None] + self.bias) / self.temperature
        odds = np.exp(logits - logits.max(axis=1, keepdims=True))
        best = odds.argmax(axis=1)
        score = np.where(known, odds.max(axis=1) / odds.sum(axis=1), 0.0)
        return [self.languages[b] if k else UNKNOWN for b, k in zip(best, known)], score

    def _add(self, waiting, sums, counts):
        if not waiting or not self.languages:
            return
        joined = np.concatenate([part for _, part in waiting])
        ends = np.cumsum([len(part) for _, part in waiting])
        buckets, starts = buckets_of(joined)
        owner = np.searchsorted(ends, starts, side="right")
        rows = np.array([row for row, _ in waiting])
        np.add.at(counts, rows, np.bincount(owner, minlength=len(rows)))
        for language in range(len(self.languages)):
            added = np.bincount(owner, weights=self.table[:, language][buckets], minlength=len(rows))
            np.add.at(sums[:, language], rows, added)


def fit(documents: DataFrame, per_language: int = PER_LANGUAGE, seed: int = 9) -> LanguageModel:
    """Train on a hash-picked sample of the documents that have a language and are not held out."""
    labelled = documents.where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    # a dirty column may hold any number of values; no more than the sample has rows can be learned
    common = labelled.groupBy("lang").count().orderBy(F.col("count").desc(), "lang").limit(MAX_SAMPLE)
    sizes = {row["lang"]: row["count"] for row in common.collect()}
    if not sizes:
        return LanguageModel((), np.zeros((BUCKETS, 0)), np.zeros(0), 1.0, 0.0)
    languages = tuple(sorted(sizes))
    each = min(per_language, MAX_SAMPLE / len(languages))
    spark = documents.sparkSession
    bounds = [(language, size, min(2 ** 63 - 1, int(each / size * 2.0 ** 64) - 2 ** 63)) for language, size in sizes.items()]
    shares_of = F.broadcast(spark.createDataFrame(bounds, "lang string, size long, bound long"))  # a row a language
    drawn = (F.col("size") <= each) | (F.xxhash64("doc_id", "text", F.lit(seed)) < F.col("bound"))
    sample = labelled.select("doc_id", "text", "lang").join(shares_of, "lang").where(F.col("text").isNotNull() & drawn).select("lang", "text")

    def start():
        def handle(batch):
            rows = [shares(text) for text in as_texts(batch["text"])]
            return pa.RecordBatch.from_arrays(
                [batch["lang"], pa.array([used.tobytes() for used, _ in rows], pa.binary()),
                 pa.array([part.tobytes() for _, part in rows], pa.binary())], ["lang", "used", "part"])
        return handle

    rows = map_texts(sample, "lang string, used binary, part binary", start).collect()
    rows.sort(key=lambda row: (row["lang"], bytes(row["used"]), bytes(row["part"])))
    features = np.zeros((len(rows), BUCKETS), np.float32)
    for at, row in enumerate(rows):
        features[at, np.frombuffer(row["used"], np.uint16)] = np.frombuffer(row["part"], np.float32)
    target = np.array([languages.index(row["lang"]) for row in rows], np.int64)
    return train(languages, features, target, seed)


def train(languages: tuple[str, ...], features: np.ndarray, target: np.ndarray, seed: int = 9,
          epochs: int = 30, batch: int = 32, rate: float = 0.5) -> LanguageModel:
    random = np.random.default_rng(seed)
    order = random.permutation(len(target))
    aside, used = order[: len(order) // 5], order[len(order) // 5:]
    embeddings = random.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    weights = random.normal(0, 0.1, (DIMENSIONS, len(languages))).astype(np.float32)
    bias = np.zeros(len(languages), np.float32)
    scale = np.float32(50)  # shares are small; a larger input lets one rate serve both layers
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        random.shuffle(used)
        for at in range(0, len(used), batch):
            rows = used[at:at + batch]
            x = features[rows] * scale
            hidden = x @ embeddings
            error = _softmax(hidden @ weights + bias)
            error[np.arange(len(rows)), target[rows]] -= 1
            error /= len(rows)
            back = error @ weights.T
            touched = np.flatnonzero(x.any(axis=0))
            weights -= step * np.clip(hidden.T @ error, -1, 1)
            bias -= step * error.sum(axis=0)
            embeddings[touched] -= step * np.clip(x[:, touched].T @ back, -1, 1)
    table = (scale * (embeddings @ weights)).astype(np.float64)
    logits, truth = features[aside] @ table + bias, target[aside]
    foreign = foreign_features(features[aside], random) @ table + bias
    temperature, reject_below = calibrate(logits, truth, foreign)
    return LanguageModel(languages, table, bias.astype(np.float64), temperature, reject_below)


def calibrate(logits: np.ndarray, truth: np.ndarray, foreign: np.ndarray, lost: float = 0.001) -> tuple[float, float]:
    """Temperature of least log loss, and the score below which a prediction is rejected.

    The threshold lies above what all but a hundredth of the ``foreign`` logits and of the wrong predictions
    reach, where it can: at most ``lost`` of the right predictions may lie below it. Where the two leave a gap it is
    nearer to the foreign ones, as a text kept by mistake does less harm than one lost.
    """
    if not len(truth):
        return 1.0, 0.0
    grid = np.geomspace(0.25, 16, 49)

    def loss(temperature):
        odds = _softmax(logits / temperature)
        return -np.log(np.maximum(odds[np.arange(len(truth)), truth], 1e-12)).mean()

    temperature = float(min(grid, key=loss))
    odds = _softmax(logits / temperature)
    hit = odds.argmax(axis=1) == truth
    if not hit.any():
        return temperature, 0.0
    scores = odds.max(axis=1)
    least_right = np.quantile(scores[hit], lost)
    others = np.concatenate([_softmax(foreign / temperature).max(axis=1), scores[~hit]])
    most_foreign = np.quantile(others, 0.99) if len(others) else 0.0
    return temperature, float(min(least_right, (least_right + 3 * most_foreign) / 4) if most_foreign < least_right else least_right)


def foreign_features(aside: np.ndarray, random: np.random.Generator) -> np.ndarray:
    """Features of texts of no learned language: those set aside with their subwords renamed, and random letters."""
    renamed = aside[:, random.permutation(BUCKETS)]
    junk = np.zeros((min(400, max(50, len(aside))), BUCKETS), np.float32)
    for row in junk:
        lengths = random.integers(2, 12, random.integers(5, 120))
        text = " ".join("".join(map(chr, random.integers(97, 123, length))) for length in lengths)
        used, part = shares(text)
        row[used] = part
    return np.concatenate([renamed, junk])


def _softmax(logits: np.ndarray) -> np.ndarray:
    odds = np.exp(logits - logits.max(axis=1, keepdims=True))
    return odds / odds.sum(axis=1, keepdims=True)


def predict(documents: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred, score, accepted of every document; undetermined texts are not accepted."""
    def start():
        def handle(batch):
            languages, score = model.predict(as_texts(batch["text"]))
            accepted = (np.array(languages, object) != UNKNOWN) & (score >= model.reject_below)
            return pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(languages, pa.string()), pa.array(score, pa.float64()),
                 pa.array(accepted.astype(bool), pa.bool_())],
                [*batch.schema.names[1:], "lang_pred", "score", "accepted"])
        return handle

    kind = documents.schema["doc_id"].dataType.simpleString()
    return map_texts(documents.select("text", "doc_id"),
                     f"doc_id {kind}, lang_pred string, score double, accepted boolean", start)


def keep_accepted(documents: DataFrame, model: LanguageModel) -> DataFrame:
    """The documents, as they are, whose language the model accepts."""
    names = documents.columns

    def start():
        def handle(batch):
            languages, score = model.predict(as_texts(batch["text"]))
            accepted = (np.array(languages, object) != UNKNOWN) & (score >= model.reject_below)
            return batch.filter(pa.array(accepted.astype(bool), pa.bool_()))
        return handle

    return map_texts(documents.select(*names), documents.schema, start)
