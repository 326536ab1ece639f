import os
import random
import re
from collections import Counter

import duckdb
import pytest

from kinweave.llm import quality, queries, sql
from rows import AWKWARD, DOCUMENTS

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def plain_measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    times = Counter(windows)
    under = {at + k for at, window in enumerate(windows) if times[window] > 1 for k in range(5)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(under))


def test_measures_of_every_kind_of_text(documents, awkward):
    rng = random.Random(8)
    texts = ["a " * 20, "a b c d e\na b c d e\n\n \na b c d e", "x\r\nx\n", "\x0b\x0c", "é ü\u00a0z # | <>", "a b c d e f a b c d e"]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 60))) for _ in range(60)]
    texts += ["\n".join(rng.choice(("p q", " p q", "", "r")) for _ in range(12)) for _ in range(20)]
    rows = [(n, text, "en", "s", 0) for n, text in enumerate(texts)]
    for df, given in ((documents(rows), rows), (awkward, AWKWARD)):
        found = quality.measures(df).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
        assert sorted(map(str, map(tuple, found.collect()))) == sorted(str((d, *plain_measures(t))) for d, t, *_ in given)


@pytest.mark.parametrize("path", [SF_DIR, None])
def test_query_equals_sql(spark, awkward, tmp_path, path):
    if path is None:
        path = str(tmp_path)
        awkward.select(*DOCUMENTS.fieldNames()).coalesce(1).write.parquet(f"{path}/documents.parquet")
    connection = duckdb.connect()
    files = f"{path}/documents.parquet" + ("/*.parquet" if path == str(tmp_path) else "")
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{files}'")
    expected = connection.execute(sql.oracle_sql()["op6_host_quality"])
    columns = [d[0] for d in expected.description]
    found = queries.queries()["op6_host_quality"](spark, path)
    assert sorted(found.columns) == sorted(columns)
    assert Counter(map(tuple, found.select(*columns).collect())) == Counter(expected.fetchall())


def test_a_host_that_fails_takes_its_documents_along_and_a_small_one_is_given_credit(documents):
    good, bad = " ".join(f"w{i}" for i in range(30)), " ".join(["# $"] * 20 + [f"w{i}" for i in range(90)])
    rows = [(n, good, "en", f"good{n % 20}", 0) for n in range(400)]
    rows += [(1000 + n, bad if n % 10 else good, "en", "bad", 0) for n in range(200)]
    rows += [(2000, bad, "en", "small", 0), (3000, good, "en", None, 0)]
    kept = {row.doc_id: row.kept for row in quality.judge(documents(rows)).collect()}
    assert not any(kept[1000 + n] for n in range(200))
    assert all(kept[n] for n in range(400)) and kept[3000]
    rates = {row.source: row for row in quality.host_rates(
        quality.measures(documents(rows), "source").select("*", *[f.alias(f"fails_{n}") for n, f in quality.rules().items()])).collect()}
    assert rates["bad"].rate_symbols < 0.9 and rates["small"].rate_symbols < 1


def test_only_dataframe_operations_and_an_empty_table(spark, awkward, nothing):
    assert quality.judge(nothing).collect() == []
    plan = quality.measures(awkward, "source")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_beta_prior():
    alpha, strength = quality.beta_prior(0.2, 0.01)
    assert strength == pytest.approx(15) and alpha == pytest.approx(3)
    assert quality.beta_prior(None, None)[1] == quality.beta_prior(0.0, 0.0)[1] == quality.STRONGEST
    assert quality.beta_prior(0.5, 0.0)[1] == quality.STRONGEST
