import html as entities
import re

import pytest
from pyspark.sql import functions as F

from cohortlens.llm import html_extract as H


def text_of(page, templates=frozenset()):
    return H.main_text(H.parse(page), set(templates))


@pytest.mark.parametrize(("page", "want"), [
    ("<html><body><header>Site</header><nav><ul><li>a</ul></nav><main><h1>T &amp; U</h1><p>one<br>two <b>th</b>ree<p>four</main><footer>f</footer>", "T & U one two three four"),
    ('<article><header><h1>T</h1></header><p>x<script>var a="</p>";</script>y</p><div class="ad">ad</div><aside>s</aside>'
     '<section class="comments"><article>c</article></section><form>f</form></article>', "T xy"),
    ('<body><div id="sidebar">s</div><div class="content"><p>a &lt; b &nbsp; c</p></div><div class="cookie-notice">n</div></body>', "a < b c"),
    ("<article><p>cut off &am", "cut off &am"), ("<article><p>a < b and <3</p><p>x<!-- c --->y</p><!-- unclosed <p>z", "a < b and <3 xy"),
    ('<article><p title="a>b">q</p><p', "q"), ("", ""), ("<article><ul><li>1<li>2</ul><table><tr><td>a<td>b<tr><td>c</table></article>", "1 2 a b c"),
    ('<div class="with-sidebar"><article class="post">x<article class="comment">c</article></article></div>', "x"),
    ('<div class="site-header">s</div><article><div class="article-header"><h1>T</h1></div>x</article>', "T x"),
    ('<div class="masthead">s</div><p>x</p>', "x"), ('<div hidden>a</div><p class="notice">n</p><p>t</p>', "t"), ("<p>only text", "only text"), ("<b>" * 5000 + "deep", "deep"), ("<<<>>>", "<<<>>>"),
])
def test_pages(page, want):
    assert text_of(page) == want


@pytest.mark.parametrize(("attributes", "kept"), [
    ('href="/hidden-gems"', True), ('style="overflow:hidden"', True), ('data-hidden="false"', True), ('href="?id=search"', True), ("href=?class=ad", True),
    ('title="the hidden class=ad"', True), ("data-id='search' data-class='ad'", True), ('aria-hidden="false"', True), ('title="an open hidden', True),
    ("hidden", False), ("HIDDEN=''", False), ('title="x"hidden', False), ("aria-hidden = 'TRUE'", False), ('href="/a" class="x ad"', False), ("id=search", False),
    ("data-x role='search'", False),
])
def test_only_real_attributes_mark_an_element(attributes, kept):
    assert text_of(f"<article><p>x</p><div {attributes}>inner</div></article>") == ("x inner" if kept else "x")


def test_driver_pages_against_their_article_markup():
    import duckdb

    for (page,) in duckdb.sql("SELECT html FROM '/root/testdata/sf0.01/pages.parquet'").fetchall():
        article = re.search(r"<article>(.*?)(</article>|$)", page, re.S)
        plain = re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", article[1]))
        assert text_of(page) == " ".join(entities.unescape(plain).split())


def site(n, host="h.example.com"):
    return [(i, f"https://{host}/{i}", f"<body><div><span>Our great site</span> for you</div><p>own text {i}</p><p>The same quoted line.</p>"
             f"<div>Read more at our site</div></body>") for i in range(n)]


def test_templates_are_counted_per_host(spark):
    rows = site(8) + [(100, "https://other.example.com/", "<body><div><span>Our great site</span> for you</div><p>x</p></body>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = {r["page_id"]: r["text"] for r in H.extract(pages).collect()}
    assert out[3] == "own text 3" and out[100] == "Our great site for you x"
    inside = [(i, "https://h.example.com/", f"<article><p>own {i}</p><p>A quoted line.</p><div>Share this <b>page</b></div></article>") for i in range(8)]
    out = {r["page_id"]: r["text"] for r in H.extract(spark.createDataFrame(inside, pages.schema)).collect()}
    assert out[2] == "own 2 A quoted line."  # a line that many articles quote stays, a container goes


def test_templates_that_rotate_on_a_large_host(spark):
    schema = "page_id long, url string, html string"
    rows = [(i, f"https://h.example.com/{i}", f"<body><p>own text {i}</p><p>Notice {i % 4} of our site.</p><ul><li>Menu {i % 8}<li>Home</ul>"
             f"<table><tr><td>size {i}<td>{'yes' if i % 9 == 0 else i}</table></body>") for i in range(144)]
    rows += [(1000 + i, f"https://h.example.com/again/{i}", "<body><p>A page that is stored many times.</p></body>") for i in range(40)]
    out = {r["page_id"]: r["text"] for r in H.extract(spark.createDataFrame(rows, schema)).collect()}
    assert out[3] == "own text 3 size 3 3" and out[9] == "own text 9 size 9 yes"
    assert out[1000] == out[1039] == "A page that is stored many times."


def test_nulls_repeats_clashes_and_empty_table(spark):
    schema = "page_id long, url string, html string"
    rows = [(1, None, "<p>a</p>"), (1, None, "<p>a</p>"), (None, "odd url", None), (2, "http://x", ""), (3, "http://x", "y" * 300_000)]
    pages = spark.createDataFrame(rows, schema).withColumns({c: F.lit("mine") for c in ("text", "_url", "own", "host", "N_chars")})
    out = H.extract(pages).collect()
    assert sorted(((r["page_id"], r["n_chars"], r["_url"], r["own"]) for r in out), key=str) == sorted(
        [(1, 1, "mine", "mine")] * 2 + [(None, 0, "mine", "mine"), (2, 0, "mine", "mine"), (3, 300_000, "mine", "mine")], key=str)
    assert H.extract(spark.createDataFrame([], schema)).collect() == []


def test_hosts():
    assert [H.host_of(u) for u in ("http://A.example.com:80/x", "https://u:p@b.example.org?q", None, "nothing")] == ["a.example.com", "b.example.org", "", ""]
