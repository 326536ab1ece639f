import random

import numpy as np
import pyarrow as pa
import pytest

from kinweave.llm import toxicity
from kinweave.llm.tables import held_out

SF_DIR = "/root/testdata/sf0.1"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, before[j] + 1, before[j - 1] + (x != y)))
    return row[-1]


def test_automata_on_the_trie_find_what_distance_says():
    rng = random.Random(7)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(3, 7))) for _ in range(60)})
    lexicon = toxicity.Lexicon([f"{word}$" for word in words])
    for _ in range(500):
        word = "".join(rng.choice("abcd") for _ in range(rng.randint(1, 9)))
        if word in words:
            continue
        expected = [n for n, term in enumerate(words) if len(term) >= toxicity.MIN_FUZZY and distance(word, term) == 1]
        assert lexicon.misspelled(word) == expected
        assert [term for term, weight in lexicon.find(word) if weight == toxicity.FUZZY] == expected


def test_beginnings_need_a_letter_behind_them():
    lexicon = toxicity.Lexicon(["achl", "moron$"], frozenset(["moran"]))
    assert lexicon.find("achl") == [] and lexicon.find("achlich") == [(0, 1.0)]
    assert lexicon.find("moran") == [] and lexicon.find("morom") == [(1, toxicity.FUZZY)]


def model(terms=("moron$", "idiot$")):
    return toxicity.ToxicityModel(terms, np.full(len(terms), 3.0), np.zeros(len(terms)), -2.0)


def test_context_separates_quotation_from_abuse():
    texts = ["you moron", "a moron", "the word moron", "he called him \"moron\" there", "a mor0n", "the m0ron, idiot", "nothing"]
    scores = model().score(pa.array(texts))
    abuse, plain, reported, quoted, fuzzy, two, none = scores
    assert abuse > plain > 0.5 and reported < 0.5 and quoted < 0.5 and plain > fuzzy > 0.5 and two > fuzzy
    assert none == pytest.approx(1 / (1 + np.exp(2.0)))


def test_null_empty_and_long_texts():
    scores = model().score(pa.array([None, "", " \n", "filler " * 200_000 + "moron", "MORON!!"]))
    assert len({round(s, 9) for s in scores[:3]}) == 1 and scores[0] < 0.5 < scores[3] and scores[4] > 0.5


def test_held_out_accuracy(spark):
    documents, labels = (spark.read.parquet(f"{SF_DIR}/{name}.parquet") for name in ("documents", "labels"))
    fitted = toxicity.fit(documents, labels)
    found = toxicity.score_documents(documents, fitted).join(labels, "doc_id")
    rows = found.where(held_out(found["doc_id"])).collect()
    toxic = [row.score >= 0.5 for row in rows if row.toxic == 1]
    clean = [row.score >= 0.5 for row in rows if row.toxic == 0]
    assert len(toxic) > 50 and np.mean(toxic) > 0.88 and np.mean(clean) < 0.02


def test_awkward_documents_and_labels(spark, awkward, nothing):
    schema = "doc_id long, quality int, toxic int, score string, text string"
    labels = spark.createDataFrame([(1, 1, 1, "", ""), (1, 1, 0, "", ""), (None, 0, 1, "", ""), (5, 0, None, "", ""), (7, 0, 0, "", "")], schema)
    for fitted in (toxicity.fit(awkward, labels), toxicity.fit(nothing, labels), toxicity.fit(awkward, labels.limit(0))):
        assert toxicity.score_documents(awkward, fitted).count() == awkward.count()
        assert toxicity.score_documents(nothing, fitted).collect() == []
        kept = toxicity.keep_clean(awkward, fitted)
        assert kept.columns == awkward.columns and kept.count() <= awkward.count()


def test_the_model_survives_pickling():
    from pyspark import cloudpickle
    copy = cloudpickle.loads(cloudpickle.dumps(model()))
    assert copy.score(pa.array(["you moron"])) == model().score(pa.array(["you moron"]))


def test_only_whole_copies_are_dropped_from_the_sample(spark):
    # all share "common", the smallest or only long word; the short ones have no long word at all
    texts = [f"common a{n} b{n}" for n in range(60)] + [f"x{n} y{n}" for n in range(60)] + ["common a0 b0", None, ""]
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = documents.selectExpr("doc_id", "CAST(doc_id % 3 = 0 AS int) AS toxic")
    taught = labels.where(~held_out(labels["doc_id"])).join(documents, "doc_id").collect()
    expected = tuple(len({row.text or "" for row in taught if row.toxic == toxic}) for toxic in (0, 1))
    assert toxicity.fit(documents, labels).used == expected


def plain_score(fitted, text):
    """A model's score by edit distance against every term and the context of each word."""
    words = (text or "").lower().split()
    whole = {term[:-1]: n for n, term in enumerate(fitted.terms) if term.endswith("$")}
    stems = {term: n for n, term in enumerate(fitted.terms) if not term.endswith("$")}
    found = {}
    for at, word in enumerate(words):
        bare = word.strip(toxicity.EDGES)
        hits = [(n, 1.0) for stem, n in stems.items() if bare.startswith(stem) and len(bare) > len(stem)]
        if bare in whole:
            hits.append((whole[bare], 1.0))
        elif bare not in fitted.not_misspelled:
            hits += [(n, toxicity.FUZZY) for term, n in whole.items() if len(term) >= toxicity.MIN_FUZZY and distance(bare, term) == 1]
        if hits:
            around = toxicity.context_weight(words[max(0, at - toxicity.WINDOW):at], word, words[at + 1:at + 1 + toxicity.WINDOW])
            for n, weight in hits:
                found[n] = found.get(n, 0.0) + weight * around
    logit = fitted.intercept + sum(fitted.weights[n] * min(x, toxicity.MOST_COUNTED) / (1 + fitted.rates[n] * len(words)) for n, x in found.items())
    return 1 / (1 + np.exp(-min(30.0, max(-30.0, logit))))


@pytest.fixture(scope="module")
def small(spark):
    return tuple(spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet") for name in ("documents", "labels"))


@pytest.fixture(scope="module")
def fitted(small):
    return toxicity.fit(*small)


def test_scores_equal_a_plain_scorer(small, fitted):
    documents, labels = small
    toxic = documents.join(labels.where("toxic = 1").select("doc_id"), "doc_id").limit(15)
    some = documents.select("doc_id", "text").limit(25).unionByName(toxic.select("doc_id", "text")).where("length(text) < 4000").collect()
    assert fitted.terms and len(some) > 20
    scores = fitted.score(pa.array([row.text for row in some], pa.string()))
    assert max(scores) > 0.5
    for row, score in zip(some, scores):
        assert score == pytest.approx(plain_score(fitted, row.text), abs=1e-9)


def test_the_model_does_not_depend_on_partitions_and_batches(small, fitted, monkeypatch):
    documents, labels = small
    from kinweave.llm import tables
    monkeypatch.setattr(toxicity, "COUNTED_ROWS", 1)
    monkeypatch.setattr(tables.map_texts, "__defaults__", (3, ""))
    other = toxicity.fit(documents.repartition(5), labels.repartition(3))
    assert other.terms == fitted.terms and other.not_misspelled == fitted.not_misspelled and other.used == fitted.used
    assert (other.weights == fitted.weights).all() and (other.rates == fitted.rates).all() and other.intercept == fitted.intercept
