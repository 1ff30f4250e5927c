"""Main text of pages: layouts by hand, the given pages against their article element, cost of broken pages."""

import html
import re
import time

import numpy as np
import pytest

from coldhaul.llm import pages
from tests.llm.conftest import SF_DIR

LONG = "A paragraph that is long enough to be content by its ratio of text to tags."


@pytest.mark.parametrize("page,text", [
    (f"<nav><a href=/>Home</a></nav><article><h1>T</h1><p>Short.</p><p>{LONG}</p><p>End.</p></article><footer>x</footer>",
     f"T Short. {LONG} End."),
    # no article element: the container that holds the content, without what its neighbours say
    (f'<body><div id="top"><div class="site-header">Name</div><ul><li><a href=a>A</a></ul></div><div class="with-sidebar"><div class="post">'
     f'<h2>T</h2><p>Short.<p>{LONG}<p>{LONG}</div><div id="sidebar"><p>{LONG}</p></div></div><div class="comments"><p>{LONG}'
     '</div><div>Legal</div>', f"T Short. {LONG} {LONG}"),
    # comments as articles, sections, a header of the article's own, lists, tables
    (f"<header><h1>Site</h1></header><main><article><header><h1>T</h1></header><section><p>{LONG}</p></section><section><ul><li>one<li>two"
     f'</ul><table><tr><td>c<td>d</table></section></article><article class="comment"><p>{LONG}</p></article></main>',
     f"T {LONG} one two c d"),
    (f'<form action=x><label>Name</label><input name=n><button>Go</button></form><div class="cookie-banner">{LONG}</div><p>{LONG}</p>', LONG),
    ('<article><p>one<noscript><p>no</p></noscript><p class="ad">no</p><p>two <span class="ad">no <span>no</span> no</span> three</p>',
     "one two three"),
    ("<article><p>x<b>y</b>z<br>w &amp; &lt;b&gt; &#233;&nbsp;&eacute; a < b 3<5</p></article>", "xyz w & <b> é é a < b 3<5"),
    ("<nav><ul><li><a href=1>one</a></li><article><h1>T</h1><p>Text</p></article>", "T Text"),  # a menu without an end
    ('<article><p>Text<script>var t="</p>";</script> goes on</p><!-- no --><style>p{}</style></article>', "Text goes on"),
    ("plain text", "plain text"), ("<p>a<p>b", "a b"), ("<article>one word</article>", "one word"),
    ("", ""), (None, ""), ("<script>x", ""), ("<p>x</p><!-- no end", "x"), ("<nav>only a menu</nav>", ""), ("<", "<"),
    ('<ul><li><a href=x>menu</a></ul>', ""), ('<p hidden>no</p><p style="display: none">no</p><p>yes</p>', "yes"),
])
def test_layouts(page, text):
    assert pages.main_text(page) == text


def test_kernel_and_lines():
    assert np.allclose(pages.smoothed(np.full(7, 3.0)), 3.0) and np.allclose(pages.smoothed(np.array([5.0])), 5.0)
    spike = pages.smoothed(np.array([0, 0, 0, 9.0, 0, 0, 0]))
    assert spike.argmax() == 3 and np.allclose(spike, spike[::-1]) and spike[0] == 0
    lines, _, _ = pages.lines_of("<p>a <b>b</b> <a href=x>link</a></p><p>c</p>")
    assert [(x.text, x.tags, x.linked) for x in lines] == [("a b link", 3, 4), ("c", 1, 0)]


def test_given_pages(spark):
    """Every given page holds one article element, which a pattern can cut out."""
    table = spark.read.parquet(f"{SF_DIR}/pages.parquet").withColumnRenamed("page_id", "p")
    table = table.selectExpr("p AS page_id", "url", "html", "'x' AS text", "1 AS n_chars", "'y' AS kind")
    found = {r.page_id: (r.url, r.text, r.n_chars) for r in pages.extract(table).collect()}
    want = {}
    for r in table.collect():
        inner = re.sub(r"</?(?:p|h1|br)\b[^>]*>", " ", re.search(r"<article>(.*?)</article>", r.html, re.S).group(1))
        text = " ".join(html.unescape(re.sub(r"</?b>", "", inner)).split())
        want[r.page_id] = (r.url, text, len(text))
    assert found == want and len(want) > 20


def test_rows_as_they_come(spark):
    given = [(1, "u", "<p>a</p>"), (1, "u", "<p>a</p>"), (None, None, "<p>b</p>"), (2, None, None)]
    found = pages.extract(spark.createDataFrame(given, "page_id long, url string, html string"))
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(
        [(1, "u", "a", 1), (1, "u", "a", 1), (None, None, "b", 1), (2, None, "", 0)], key=repr)
    assert pages.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize("page", ["<div>" * 50_000 + "x", "<b>" * 50_000 + "</p>" * 50_000 + "x</i>" * 50_000,
                                  "<div class=ad>" * 50_000 + "<article>x" * 5000 + "</div>" * 50_000, "<p>word word</p>" * 50_000])
def test_long_and_broken_pages_take_linear_time(page):
    started = time.time()
    pages.main_text(page)
    assert time.time() - started < 10
