import html
import random
import re
import time
from itertools import product

import pytest

from kinweave.llm import extract
from kinweave.llm.extract import main_text

ARTICLE = "This is a sentence of the article, long enough to be read as text by anyone who looks at it."


def test_what_is_no_article_goes():
    page = f"""<!DOCTYPE html><html><head><title>Title</title><style>p {{a:b}}</style><script>var x = "<p>no</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a><li><a href="/b">News</a></ul></nav>
<div class="cookie-notice"><p>We use cookies, and we would like you to accept them all right now.</p></div>
<div class="layout with-sidebar"><main><article><header><h1>Headline &amp; more</h1></header><p>{ARTICLE}<br>Second   line
here</p><!-- a > b <p>no</p> --><ul><li>one<li>two</ul><div class="ad"><p>Buy this now, it is cheap, and good for you.</p></div>
<form><label>Mail</label><input><button>Go</button></form><aside>Related: {ARTICLE}</aside><p>Last <b>bold</b>&#33;</p></article>
<section id="comments"><article><p>{ARTICLE}</p></article></section></main>
<div id="sidebar"><p>{ARTICLE}</p></div></div><footer><p>&copy; us. {ARTICLE}</p></footer></body></html>"""
    assert main_text(page).split("\n") == ["Headline & more", ARTICLE, "Second line here", "one", "two", "Last bold!"]


def test_a_page_that_says_nothing_of_itself():
    page = (f"<div><a href=x>Home</a> <a href=y>About us</a></div><div><p>{ARTICLE}</p><p>Short one.</p><p>{ARTICLE}</p></div>"
            "<div><a href=z>Imprint</a></div>")
    assert main_text(page).split("\n") == [ARTICLE, "Short one.", ARTICLE]


@pytest.mark.parametrize("page, text", [
    ("", ""), ("<", ""), ("<p", ""), ("<!-- x", ""), ("<script>a", ""), ("<article>a<b>c</b>d</p></div>x", "acd\nx"),
    ("<head><title>x</title><p>Hello world, it is me.", "Hello world, it is me."), ("<article>&lt;p&gt; a &amp;amp; b", "<p> a &amp; b"),
    ("<article><p>a<p>b<script>if (a<b && 'x\"</p>y</script>c", "a\nbc"), ("<article>a\u00a0 b\t\n c</article>", "a b c"),
    ("<form id=all><article><p>In a form.</p></article></form>", "In a form."), ("<article><td>x</article>", "x"),
])
def test_odd_pages(page, text):
    assert main_text(page) == text


def test_a_very_long_page_and_a_deep_one():
    assert main_text("<article>" + f"<p>{ARTICLE}</p>" * 20_000 + "</article>").count("\n") == 19_999
    assert main_text("<article>" + "<div>" * 5000 + "deep" + "</div>" * 5000) == "deep"


def cut_cost(kept, source, sink, edges):
    return (sum(w for k, w in zip(kept, source) if not k) + sum(w for k, w in zip(kept, sink) if k)
            + sum(w for a, b, w in edges if kept[a] != kept[b]))


def test_the_cut_is_minimal():
    rng = random.Random(9)
    for _ in range(200):
        n = rng.randint(1, 8)
        source, sink = ([rng.choice((0.0, rng.random() * 4)) for _ in range(n)] for _ in range(2))
        edges = [(rng.randrange(n), rng.randrange(n), rng.random() * 2) for _ in range(rng.randint(0, 14))]
        edges = [(a, b, w) for a, b, w in edges if a != b]
        least = min(cut_cost(kept, source, sink, edges) for kept in product((False, True), repeat=n))
        assert cut_cost(extract.minimum_cut(n, source, sink, edges), source, sink, edges) == pytest.approx(least, abs=1e-6)


def test_smoothing_takes_an_uncertain_block_with_its_neighbours():
    assert extract.minimum_cut(3, [3.0, 0.6, 3.0], [0.1, 0.9, 0.1], [(0, 1, 0.5), (1, 2, 0.5)]) == [True, True, True]
    assert extract.minimum_cut(3, [3.0, 0.6, 3.0], [0.1, 0.9, 0.1], []) == [True, False, True]


def test_every_given_page(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    found = {r.page_id: r for r in extract.extract_pages(pages).collect()}
    for page_id, url, page in pages.collect():
        inside = page[page.index("<article>") + 9:page.index("</article>")]
        blocks = (" ".join(html.unescape(re.sub("<[^>]*>", "", part)).split()) for part in re.split(r"</?(?:p|h1|br)>", inside))
        text = "\n".join(block for block in blocks if block)
        assert (found[page_id].url, found[page_id].text, found[page_id].n_chars) == (url, text, len(text))


def test_nulls_repeated_rows_and_an_empty_table(spark):
    schema = "page_id long, url string, html string, text string, n_chars long"
    rows = [(None, None, None, "x", 1), (1, "u", "", "x", 1), (2, "u", f"<article>{ARTICLE}", "x", 1), (2, "u", f"<article>{ARTICLE}", "x", 1)]
    found = sorted(map(tuple, extract.extract_pages(spark.createDataFrame(rows, schema)).collect()), key=str)
    assert found == sorted([(None, None, "", 0), (1, "u", "", 0), (2, "u", ARTICLE, len(ARTICLE)), (2, "u", ARTICLE, len(ARTICLE))], key=str)
    assert extract.extract_pages(spark.createDataFrame([], schema)).collect() == []


@pytest.mark.parametrize("name", ["sidebar-right", "page-header-visible", "layout cookie-accepted", "no-js promo-top"])
def test_layout_names_of_wrappers_do_not_lose_the_article(name):
    prose = f"<h1>Headline</h1><p>{ARTICLE}</p><p>{ARTICLE} {ARTICLE}</p><p>Short one.</p><p>{ARTICLE}</p>"
    menu = "<nav><a href=x>Home</a></nav>"
    for inside in (f"<article>{prose}</article>", f"<main>{prose}</main>", f"<div>{prose}</div>"):
        found = main_text(f"<body><div class='{name}'>{menu}{inside}</div><footer>&copy; us. {ARTICLE}</footer></body>")
        assert found.count(ARTICLE) == 4 and "Home" not in found and "us." not in found
    # a name above a part of the page still speaks against that part
    found = main_text(f"<div id='{name}'><main>{prose}</main><div class='comments'><p>{ARTICLE} No.</p></div></div>")
    assert found.count(ARTICLE) == 4 and "No." not in found


def test_an_article_outweighs_an_outer_name():
    assert main_text("<div class='sidebar-right'><article>a<b>c</b>d</article></div><p>Some words outside of it.</p>").startswith("acd")


@pytest.mark.parametrize("start", [
    '<article data-state="not hidden">', '<article data-title="a hidden gem" data-id="comments-7">', "<article title='the role=form question'>",
    '<article title="what class=ad means" data-class=ad x-role=form>', '<article title = "a > b" class=\'x y\'>', "<article =hidden a==hidden>",
])
def test_attributes_are_read_as_pairs(start):
    text = f"{start}<p title='the role=form question' data-hidden>{ARTICLE}</p><p data-title=\"a hidden gem\">{ARTICLE}</p></article>"
    assert main_text(text) == f"{ARTICLE}\n{ARTICLE}"
    assert main_text(f"<article><p>{ARTICLE}</p><p HIDDEN>no</p><p role='Dialog'>no</p><p aria-hidden = true>no</p></article>") == ARTICLE


@pytest.mark.parametrize("outer", ["<aside>", "<aside class='layout'>", "<div role=dialog>", "<div hidden>", "<div style='display: none'>", "<form><fieldset>"])
def test_an_article_below_what_speaks_against_a_place_is_kept(outer):
    menu, prose = "<nav><a href=x>Home</a></nav>", f"<h1>Headline</h1><p>{ARTICLE}</p><p>{ARTICLE}</p>"
    assert main_text(f"{menu}{outer}{menu}<article>{prose}</article></div>") == f"Headline\n{ARTICLE}\n{ARTICLE}"
    # not where the page has its prose elsewhere, nor below navigation
    assert main_text(f"<main>{prose}</main>{outer}<article><p>{ARTICLE} No.</p></article></div>") == f"Headline\n{ARTICLE}\n{ARTICLE}"
    assert main_text(f"<main>{prose}</main><nav>{outer}<article><p>{ARTICLE} No.</p></article></nav>") == f"Headline\n{ARTICLE}\n{ARTICLE}"


@pytest.mark.parametrize("broken", [
    "<a " * 350_000, "<div>" * 100_000 + "</x>" * 100_000, "<a \"" * 250_000, "<a '\"" * 200_000, "<!" * 500_000, "<a<b" * 250_000, "</script" * 120_000,
    "<script>" + "</script" * 120_000, "<b>" * 150_000 + "<p>x" * 100_000, "<b>" * 100_000 + "<li>x" * 100_000, "<!--" * 250_000,
    "<form>" * 100_000 + "<article>x" * 50_000, "<div>x" * 150_000, "<aside><article>x" * 40_000, "<td><dt><li><tr><option>" * 30_000,
])
def test_a_megabyte_of_broken_markup_takes_seconds(broken):
    start = time.monotonic()
    main_text(broken)
    main_text(f"<article>{ARTICLE}{broken}")
    assert time.monotonic() - start < 30
