"""Main text of pages: the table's articles, other layouts, and odd html."""

import html as entities
import re
from collections import Counter

import pytest

from tests.conftest import TESTDATA
from terratally.llm import extraction
from terratally.llm.queries import QUERIES

PAGES = "page_id long, url string, html string, text string, n_chars string"
LAYOUT = """<html><body><div class="top-menu"><a href=/>Home</a> <a href=/x>News</a></div>
<div id="content"><h2>Title here</h2><div><p>First paragraph is long enough to be a real sentence,
with many&nbsp;words &amp; a &lt;tag&gt; in it.</p><p>Short one.<ul><li>Item one<li>Item two</ul></div>
<div class="comments"><h3>Comments</h3><p>I think this is a very long comment that goes on and on.</p></div></div>
<div class="sidebar"><p>Buy our things now because they are really cheap and good for you.</p></div>
<form><p>Subscribe to our newsletter today please do it now.</p></form><p>&copy; 2020 Example Corp</p></body></html>"""
WANTED = """Title here
First paragraph is long enough to be a real sentence, with many words & a <tag> in it.
Short one.
Item one
Item two"""


def article(source):
    inner = re.search(r"<article>(.*?)</article>", source, re.S).group(1)
    blocks = re.split(r"</?(?:p|h1)>", inner)
    texts = (" ".join(entities.unescape(re.sub(r"<[^>]*>", " " , b.replace("<b>", ""))).split()) for b in blocks)
    return "\n".join(t for t in texts if t)


def test_table(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{TESTDATA}/pages.parquet").collect()}
    rows = QUERIES["op10_html_extraction"](spark, TESTDATA).collect()
    assert len(rows) == len(pages)
    for row in rows:
        assert row["text"] == article(pages[row["page_id"]]["html"])
        assert row["n_chars"] == len(row["text"]) and row["url"] == pages[row["page_id"]]["url"]


@pytest.mark.parametrize("trained", [False, True])
def test_layout_without_article(spark, trained):
    model = extraction.Model(Counter())
    if trained:
        model = extraction.train(spark.read.parquet(f"{TESTDATA}/pages.parquet"))
    assert extraction.main_text(LAYOUT, model) == WANTED


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("", ""),
        ("<article><p>a  b\n c<p>d<script>var x='</p>';</script><!-- no --> e</article>", "a b c\nd e"),
        ("<ARTICLE><DIV>Upper &eacute;&#233;&#xe9;</DIV></ARTICLE>", "Upper ééé"),
        ("<article><p>open <b>never closed", "open never closed"),
        ("<article><nav>menu</nav><header>top</header><p>kept</p><aside>side</aside></article>", "kept"),
        ("<article><p title=\"a > b\">quoted</p><p x='>'>again</p><p y=\"unclosed>third</p></article>", "quoted\nagain\nthird"),
        ("<article><table><tr><td>a<td>b<tr><td>c</table></article>", "a\nb\nc"),
        ("<style>" + "x" * 10, ""),
        ("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</article>", "deep"),
    ],
)
def test_odd_html(source, text):
    assert extraction.main_text(source, extraction.Model(Counter())) == text


def test_marginals_are_exact():
    """Message passing agrees with summing over all labellings of a small tree."""
    from itertools import product
    from math import exp, log

    model = extraction.Model(Counter())
    page = extraction.parse("<div><p>one two three four five.</p><ul><li>x</li></ul></div>")
    odds = [sum(model.odds.get(f, 0.0) for f in features) for features in page.features]
    weight = [[0.0, 0.0] for _ in odds]
    for labels in product((0, 1), repeat=len(odds)):
        score = sum(x for x, b in zip(odds, labels) if b)
        score += sum(model.potential[labels[page.parents[i]], labels[i]] for i in range(1, len(odds)))
        for i, b in enumerate(labels):
            weight[i][b] += exp(score)
    assert model.marginals(page) == pytest.approx([log(b / a) for a, b in weight])


def test_rows(spark):
    rows = [(1, "u", "<article><p>Text.</p></article>", "x", "x")] * 2 + [(None, None, None, "x", "x"), (3, "u", "", "x", "x")]
    pages = spark.createDataFrame(rows, PAGES)
    found = sorted((tuple(r) for r in extraction.extract(pages).collect()), key=str)
    assert found == sorted([(1, "u", "Text.", 5)] * 2 + [(None, None, "", 0), (3, "u", "", 0)], key=str)
    assert extraction.extract(pages.limit(0)).collect() == []


def test_missing_end_tags_lose_no_text():
    """</head> is optional, and others that are missing end with what is around them."""
    body = "<article><p>The text that has to stay.</p></article>"
    pages = [f"<html><head><meta charset=x><title>t</title><body>{body}", f"<head><title>t</title>{body}"]
    pages += [f"<head><title>never closed<body>{body}"]
    pages += [
        f"<body><div><{name}><b>left out</b></div>{body}"
        for name in ("svg", "button", "select", "object", "canvas", "audio", "video", "template", "datalist")
    ]
    pages += [f"<body><div><{name}>left out</div>{body}" for name in ("textarea", "iframe")]
    for page in pages:
        found = [t for t in extraction.parse(page).texts if t]
        assert found == ["The text that has to stay."], page
    nested = f"<div><object><div>in</div><p>in</p></object>{body}</div>"
    assert [t for t in extraction.parse(nested).texts if t] == ["The text that has to stay."]


@pytest.mark.parametrize(
    "piece", ["<a", "<a b='", "<", "</a", "<title><p>", "<div>", "</x>", "<!--", "<svg></y>", "<a" + "b" * 40 + ' c="']
)
def test_broken_pages_take_time_in_proportion(piece):
    """Repeats of what lacks its end: the text before and after a closed article stays."""
    import time

    times = []
    for repeats in (20_000, 80_000):
        begun = time.perf_counter()
        extraction.parse("<article><p>kept</p></article>" + piece * repeats)
        times.append(time.perf_counter() - begun)
    assert times[1] < 9 * times[0] + 1


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("<article><p>a < b and c <d", "a < b and c <d"),
        ("<article><p>kept<!-- never closed", "kept"),
        ("<article><p>kept<!-- never <b>closed</b> here", "kept"),
        ("<article><p>kept</p><p>too<!-- closed --> here <e", "kept\ntoo here <e"),
    ],
)
def test_missing_closing_brackets(source, text):
    assert extraction.main_text(source, extraction.Model(Counter())) == text
