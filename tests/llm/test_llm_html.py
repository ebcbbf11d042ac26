"""Main text by block rules: expected texts are written by hand."""

import re

import pytest
from pyspark.sql import functions as F

from grist.llm import html_extract as H

PAGE = """<!DOCTYPE html><html><head><title>T &amp; x</title><style>p{a:b}</style><script>var t="</p>";</script></head>
<body class="has-sidebar"><header><h2>The site of the town and of its people</h2></header>
<nav><ul><li><a href="/a">The</a></li><li><a>and</a></li></ul></nav><!-- <p>no</p> --><div class="ad">Buy of the best for all.</div>
<article><header class="article-header"><h1>On the sea</h1></header><p><b>Short.<br>Two<p>caf&eacute; &#8217;&#x41; &copy &lt;b&gt; a&nbsp;b</p>
<p>x</p><form><p>Name of the user</p><input></form><aside>See also the other one</aside>
<table><tr><td>1 | 2</td><td>3</td></tr></table><div id="comments"><article><p>I like the story and all of it.</p></article></div>
<p hidden>gone</p><p>The <a href="#">end</a> of<span> it</span>.</p></article>
<div class="cookie-notice">We use cookies for the best of the web, and for you.</div><footer>&copy; The town and its people in the"""


def test_article_without_its_surroundings():
    assert H.main_text(PAGE) == "On the sea Short. Two café ’A © <b> a b x 1 | 2 3 The end of it."


def test_page_without_article_uses_text_rules():
    long = "It was the best of times and it was the worst of times in all of the land, and they went on with it as before. " * 3
    links = "".join(f'<li><a href="/{i}">Section number {i} of the site</a></li>' for i in range(8))
    page = f"<body><div><ul>{links}</ul></div><div><p>{long}</p><p>Yes.</p><p>{long}</p></div><div>{'xxqq zzvv ' * 40}</div><div>Top</div></body>"
    text = " ".join(long.split())
    # 'Yes.' lies between good blocks; 'Top' is nearest to the block without stop words
    assert H.main_text(page) == f"{text} Yes. {text}"


def test_second_pass_takes_the_nearest_label():
    block = lambda t: (t, 0, 0, False)      # noqa: E731
    found = [block("a")] * 7
    G, B, O = H.GOOD, H.BAD, H.OPEN
    assert H.second_pass(found, [O, G, O, O, O, B, O]) == [G, G, G, G, B, B, B]
    assert H.second_pass(found[:2], [O, O]) == [G, G]


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("plain words only", "plain words only"), ("<p>a < b and 3 <4</p>", "a < b and 3 <4"), ("<p>cut <a href=", "cut"),
    ("<script>alert(1)", ""), ("<p>one<p>two", "one two"), ("<p>&amp;lt; &bogus; &#xD800;</p>", "&lt; &bogus; �"),
    ("<div>a<!-- x > y -->b</div>", "ab"), ('<p title="a > b">t</p>', "t"), ("<svg><p>in</p></svg><p>out</p>", "out"),
])
def test_defined_cases(page, text):
    assert H.main_text(page) == text


def test_long_and_broken_pages_take_linear_time():
    import time

    for page in ("<p>a " * 100_000, '<a href="x ' * 50_000, "<" * 300_000, "<div class='x'>" * 50_000 + "t", "a" * 2_000_000):
        t = time.perf_counter()
        H.main_text(page)
        assert time.perf_counter() - t < 20


def test_frame_keeps_other_columns_and_takes_nulls(spark):
    rows = [(1, "u", "<p>the a</p>", "old"), (1, "u", "<p>the a</p>", "old"), (2, None, None, None)]
    df = H.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string"))
    assert sorted(map(tuple, df.select("page_id", "text").collect())) == [(1, "the a"), (1, "the a"), (2, "")]
    assert H.extract(df.limit(0)).count() == 0


def test_query_against_a_plain_reading_of_the_test_pages(spark):
    import html

    from grist.llm.registry import QUERIES

    pages = {r.page_id: r.html for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()}
    for r in QUERIES["op1_html_extraction"](spark, "/root/testdata/sf0.001").collect():
        body = re.search(r"<article>(.*)</article>", pages[r.page_id], re.S).group(1)
        expected = " ".join(html.unescape(re.sub(r"<[^>]*>", " ", re.sub("</?b>", "", body))).split())
        assert (r.text, r.n_chars) == (expected, len(expected))


LONG_TEXT = "The words of the story are here and it is that which the reader came for, so all of it is in the text that is kept at the end of the day."


def test_many_unclosed_elements_hide_no_end_tag():
    items = "".join(f"<li><a href='/{i}'>Entry {i}</a>" for i in range(300))
    rows = "".join(f"<tr><th>Row {i}<td>cell {i}" for i in range(300))
    body = f"<article><p>{LONG_TEXT}</p></article>"
    after = "<div>Some other words after it that are no part of the main text.</div>"
    for page in (f"<nav><ul>{items}</ul></nav>{body}", f"<nav>{items}</nav>{body}", f"<aside><table>{rows}</table></aside>{body}",
                 f"<nav>{'<div>' * 300}menu</nav>{body}", f"<nav><ul>{items}</ul></nav>{body}{after}"):
        assert H.main_text(page) == LONG_TEXT
    inside = f"<article><p>{LONG_TEXT}</p><table>{rows}</table></article>{after}"
    assert H.main_text(inside) == LONG_TEXT + "".join(f" Row {i} cell {i}" for i in range(300))


def test_siblings_end_items_and_cells():
    for page in ("<ul><li class='menu'>Home<li>words</ul>", "<ul><li class='menu'><div>Home<li>words</ul>",
                 "<table><tr><td class='menu'>Home<td>words</table>", "<table><tr><td class='menu'>Home<th>words</table>",
                 "<table><tr class='menu'><td>Home<tr><td>words</table>", "<table><tbody class='menu'><tr><td>Home<tfoot><tr><td>words</table>"):
        assert H.main_text(page) == "words", page
    # an inner list or table is no sibling
    for page in ("<ul><li class='menu'>Home<ul><li>a<li>b</ul><li>words</ul>", "<table><tr><td class='menu'>Home<table><tr><td>a<td>b</table><td>words</table>"):
        assert H.main_text(page) == "words", page


def test_closing_deep_pages_takes_linear_time():
    import time

    n = 30_000
    for page in ("<div>" * n + "t" + "</div>" * n, "<ul><li>a" * n + "</ul>" * n, "<table><tr><td>" * n + "</table>" * n,
                 "<span>" * n + "</p>" * n, "<div>" * n + "</ul></li></td>" * n, "<li>a" * n + "</nav>" * n, "<span>a<div>" * n + "<p>" * n):
        t = time.perf_counter()
        H.main_text(page)
        assert time.perf_counter() - t < 10
