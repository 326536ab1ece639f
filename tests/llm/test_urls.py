import random
import re
import time
from collections import Counter
from itertools import combinations

import pytest

from kinweave.llm import urls

URLS = [
    None, "", "no scheme", "http://Example.ORG/es/1?x=1", "https://a.example.org/en/12", "https://a.example.org/en/2#t", "http://org",
    "http://x.org/", "http://com/fr/", "http://b.com/fr", "http://b.com/de/?q", "http://xcom/de/", "http://b.com?/de/", "http://b.com#/de/",
    "http://example.org/es", "a://b://c.com/de/", "http://notexample.org/es/1", "http://u@b.com:80/de/", "http://ÉX.com/fr/É", "x://\n/de/",
]


def plain_judge(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(h + p, v) for h, p, v in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits, key=lambda r: len(r[0])) if fits else (None, None))


@pytest.fixture(scope="module")
def pages(spark):
    def table(rows):
        return spark.createDataFrame(rows, "page_id long, url string, html string, host string, rule string, tokens string, page_key string")
    return table


def row(page_id, url):
    return page_id, url, "", "clash", "clash", "clash", "clash"


def test_listed_rules(pages):
    found = {r.page_id: r for r in urls.judge(pages([row(n, url) for n, url in enumerate(URLS)] + [row(None, URLS[7])] * 2)).collect()}
    for n, url in enumerate(URLS):
        host, path, rule, verdict = plain_judge(url)
        assert (found[n].host, found[n].path, found[n].rule) == (host, path, rule)
        assert found[n].verdict == verdict if verdict else found[n].verdict in ("allow", "block")
    assert found[0].verdict == found[1].verdict == found[2].verdict == "allow"
    assert urls.judge(pages([row(n, url) for n, url in enumerate(URLS)] + [row(None, URLS[7])] * 2)).count() == len(URLS) + 2


def test_nothing_and_nothing_labelled(pages):
    assert urls.judge(pages([])).collect() == []
    found = urls.judge(pages([row(1, "http://x.net/a"), row(2, None)])).collect()
    assert {(r.page_id, r.rule, r.verdict) for r in found} == {(1, None, "allow"), (2, None, "allow")}


def brute_rules(labelled, min_support, min_confidence):
    """Rules by counting every combination of every row, pruned by their parts."""
    counts, both = Counter(), Counter()
    for tokens, label in labelled:
        for size in range(1, len(tokens) + 1):
            for part in combinations(sorted(tokens), size):
                counts[part] += 1
                both[part, label] += 1
    least = min_support * len(labelled)
    rules = {key: n / counts[key[0]] for key, n in both.items() if n >= least and n / counts[key[0]] >= min_confidence}
    return {
        (part, label): c for (part, label), c in rules.items()
        if not any(rules.get((smaller, label), 0) >= c for size in range(1, len(part)) for smaller in combinations(part, size))
    }


@pytest.fixture(scope="module")
def mined(spark):
    rows = []
    for n in range(400):
        tokens = [f"h0:{('com', 'net', 'org')[n % 3]}", f"d:{('en', 'de')[n % 2]}", f"h1:s{n % 7}", f"q:{n % 5}"][: 3 + n % 2]
        rows.append((tokens, "block" if n % 3 == 0 and n % 2 or n % 7 == 1 else "allow"))
    return rows


def test_mined_rules_equal_counting(spark, mined):
    df = spark.createDataFrame(mined, "tokens array<string>, label string").unionByName(
        spark.createDataFrame([(["h0:com"], None)], "tokens array<string>, label string"))
    found = {(tuple(r.antecedent), r.label): r.confidence for r in urls.mine_rules(df, 0.02, 0.8).collect()}
    expected = brute_rules(mined, 0.02, 0.8)
    assert found.keys() == expected.keys() and len(found) > 5
    assert all(found[key] == pytest.approx(expected[key]) for key in found)


def test_the_index_finds_the_best_rule_of_every_url(spark, mined):
    rules = urls.mine_rules(spark.createDataFrame(mined, "tokens array<string>, label string"), 0.02, 0.8)
    plain = [(set(r.antecedent), r.confidence, r.label) for r in rules.collect()]
    asked = spark.createDataFrame([(n, tokens) for n, (tokens, _) in enumerate(mined)], "page_key long, tokens array<string>")
    found = {r.page_key: (r.confidence, r.label) for r in urls.match_rules(asked, rules).collect()}
    for n, (tokens, _) in enumerate(mined):
        fits = [(c, label) for part, c, label in plain if part <= set(tokens)]
        assert found.get(n) == (max(fits) if fits else None)


def test_no_python(pages):
    df = urls.with_parts(pages([row(1, "https://www.a.b.example.com/en1/x/y.html?utm=1&b=2&c=3&d=4#z")]))
    plan = df.withColumn("listed", urls.listed_rule()).select(urls.tokens())._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_every_part_of_a_url_is_a_token(pages):
    df = urls.with_parts(pages([row(1, "https://www.a.b.example.com/en1/x/z2//y.b7.html?utm=1&b=2&c=3&d=4#z"), row(2, "http://a/b/"), row(3, "http://a/b")]))
    found = {r.page_id: r.t for r in df.select("page_id", urls.tokens().alias("t")).collect()}
    assert found[1] == ["h0:com", "h1:example", "h2:b", "h3:a", "h4:www", "d:en0", "d1:x", "d2:z0", "n:y.b0", "x:html",
                        "q:utm", "q:b", "q:c", "q:d"]
    assert found[2] == ["h0:a", "d:b"] and found[3] == ["h0:a", "n:b"]


def test_verdicts_use_deep_directories_labels_and_fields(pages):
    rows = [row(n, f"http://b.com/{verdict}/p/q{verdict}/?a&b&c&f{verdict}") for verdict in ("de", "fr") for n in range(20)]
    asked = {100: "http://x.net/zz/p/qde/", 101: "http://x.net/?a&b&c&fde", 102: "http://x.net/zz/p/qfr/", 103: "http://x.net/?a&b&c&ffr"}
    found = {r.page_id: r.verdict for r in urls.judge(pages(rows + [row(n, url) for n, url in asked.items()])).collect() if r.page_id >= 100}
    assert found == {100: "block", 101: "block", 102: "allow", 103: "allow"}


def test_a_long_template_does_not_multiply_rules(spark):
    same = [f"d{n}:t" for n in range(40)]
    rows = [(same + ["q:a"], "block")] * 10 + [(same, "allow")] * 10 + [(["h0:x"], "allow")] * 10
    rules = urls.mine_rules(spark.createDataFrame(rows, "tokens array<string>, label string"), 0.1, 0.5)
    assert rules.count() == 4  # the template for both labels, q:a, h0:x
    asked = spark.createDataFrame([(1, ["d7:t"]), (2, ["d39:t", "q:a"]), (3, ["d40:t"])], "page_key long, tokens array<string>")
    found = {r.page_key: (r.confidence, r.label) for r in urls.match_rules(asked, rules).collect()}
    assert found == {1: (0.5, "block"), 2: (1.0, "block")}


def test_many_optional_parts_do_not_explode(spark):
    """Twenty fields of which each URL has four in five: 2 ** 20 combinations, of which the telling ones are found."""
    rng = random.Random(5)
    rows = []
    for _ in range(1000):
        tokens = [f"q:f{n}" for n in range(20) if rng.random() < 0.8]
        both = {"q:f3", "q:f7", "q:f11"} <= set(tokens)
        rows.append((tokens, "block" if both and rng.random() < 0.97 else "allow"))
    start = time.monotonic()
    rules = {(tuple(r.antecedent), r.label): r for r in urls.mine_rules(spark.createDataFrame(rows, "tokens array<string>, label string"), 0.005, 0.9).collect()}
    assert time.monotonic() - start < 120
    assert (("q:f11", "q:f3", "q:f7"), "block") in rules
    for (part, label), rule in rules.items():
        seen = Counter(found for tokens, found in rows if set(part) <= set(tokens))
        assert rule.confidence == pytest.approx(seen[label] / sum(seen.values())) and rule.support == pytest.approx(seen[label] / 1000)
        assert rule.confidence >= 0.9 and rule.support >= 0.005
        for size in range(1, len(part)):
            for smaller in combinations(part, size):
                assert (smaller, label) not in rules or rules[smaller, label].confidence < rule.confidence


def test_an_item_that_settles_the_label_needs_no_company(spark):
    rows = [(["h0:bad", f"q:{n % 3}", f"d:{n % 2}", "all"], "block") for n in range(60)] + [([f"q:{n % 3}", f"d:{n % 2}", "all"], "allow") for n in range(40)]
    rules = urls.mine_rules(spark.createDataFrame(rows, "tokens array<string>, label string"), 0.01, 0.55)
    found = {(tuple(r.antecedent), r.label): r.confidence for r in rules.collect()}
    assert found == {key: pytest.approx(value) for key, value in brute_rules(rows, 0.01, 0.55).items()}
    assert not [part for part, _ in found if len(part) > 1 and {"h0:bad", "all"} & set(part)]


def test_items_that_tell_little_alone_make_rules_too(spark):
    """Nine fields that tell a little by themselves, and two that tell nothing unless both are there: no number of items is too many."""
    rng = random.Random(11)
    rows = []
    for n in range(600):
        label = ("block", "allow")[n % 2]
        tokens = [f"q:t{i}" for i in range(9) if rng.random() < (0.95 if label == "block" else 0.75)]
        pair = [["q:x", "q:y"], []][n // 2 % 2] if label == "block" else [["q:x"], ["q:y"]][n // 2 % 2]
        rows.append((tokens + pair, label))
    rules = urls.mine_rules(spark.createDataFrame(rows, "tokens array<string>, label string"), 0.05, 0.9)
    found = {(tuple(r.antecedent), r.label): r.confidence for r in rules.collect()}
    expected = brute_rules(rows, 0.05, 0.9)
    assert (("q:x", "q:y"), "block") in expected
    assert found.keys() == expected.keys() and all(found[key] == pytest.approx(expected[key]) for key in found)
