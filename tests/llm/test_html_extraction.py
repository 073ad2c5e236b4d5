"""Main text of pages against the generator's markup, planted templates and difficult pages."""

import html
import re
import time

import pytest
from pyspark.sql import functions as F

from millrace.llm import html_extraction as hx
from millrace.llm.html_tree import Tree

NONE = frozenset()


def text_of(markup):
    return hx.Page(markup).text(NONE, NONE)


def plain(markup):
    """The article of a generated page, by its known markup."""
    article = re.search("<article>(.*)</article>", markup, re.S)[1]
    blocks = (" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1)>", article))
    return "\n".join(b for b in blocks if b)


def test_query(spark, sf_medium):
    expected = {r.page_id: (r.url, plain(r.html)) for r in spark.read.parquet(f"{sf_medium}/pages.parquet").collect()}
    found = hx.query(spark, sf_medium).collect()
    assert len(found) == len(expected)
    for r in found:
        assert (r.url, r.text) == expected[r.page_id]
        assert r.n_chars == len(r.text)


def test_article_without_its_surroundings():
    page = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style></head><body class="comments-open">
    <header><h1>Site</h1></header><div id="cookie-notice">We use them</div><nav><a href=x>Home</a></nav>
    <main class="with-sidebar"><article class="post"><header><h1>Title &eacute;&nbsp;x</h1></header><p>One <b>two</b>
 three<br>four<p>Five &lt;tag&gt; a < b &copy 2020 &am<ul><li>i1<li>i2</ul><aside>side</aside>
 <div class="ad">buy</div><form><p>mail</p></form><pre>a
   b</pre><table><tr><td>c1<td>c2</table><!-- <p>no</p> --><script>if (a < b) "</p>"</script>
 <section class="comments"><article><p>nice</p></article></section><p hidden>h<p style="display: none">h</p>
 <footer>foot</footer></article></main><div class="sideBar">sb</div><footer>f</footer></body></html>"""
    lines = ["Title \u00e9 x", "One two three four", "Five <tag> a < b \u00a9 2020 &am", "i1", "i2", "a b", "c1", "c2"]
    assert text_of(page) == "\n".join(lines)


@pytest.mark.parametrize(
    "markup,text",
    [
        ("", ""),
        ("   ", ""),
        ("no markup\n at all", "no markup at all"),
        ("<p>a<p>b", "a\nb"),
        ("<p>a</b></div></p>b", "a\nb"),
        ("<p>a<!-- never closed <p>b", "a"),
        ("<p>a<script>never closed <p>b", "a"),
        ("<p>a<p class='b", "a"),
        ("<p>1 < 2 &amp; 3 > 2 &#x41;&#66;", "1 < 2 & 3 > 2 AB"),
        ("<article></article><p>body", "body"),
        ("<main><p>m</p></main><p>other", "m"),
        ("<div class=menu>x</div><ul><li><a>One link</a><li><a>Two</a></ul><p>rest <a>of</a> it", "rest of it"),
        ("<div class='no-sidebar'><p>kept</div>", "kept"),
        ("<div class=widget><h1>T</h1><p>kept</div>", "T\nkept"),
        ("<article><p>first</article><article class=related><p>x</article>", "first"),
        ("<section id=comments><article>c</article></section><article><h1>t</h1>b</article>", "t\nb"),
        ("<ARTICLE><P>Upper</P></ARTICLE>", "Upper"),
        ("<article><p>\ud800 \u00a0 x</article>", "\ud800 x"),
    ],
)
def test_small_pages(markup, text):
    assert text_of(markup) == text


def test_subtree_hashes_ignore_attributes_and_white_space():
    one = Tree("<nav class=a><ul><li>x  y</li></ul></nav>")
    other = Tree("<p>z</p><nav class=b> <ul>\n<li> x y </ul></nav>")
    assert one.hashes[one.tags.index("nav")] == other.hashes[other.tags.index("nav")]
    assert one.hashes[one.tags.index("li")] != Tree("<li>x z</li>").hashes[1]


def test_long_pages_take_time_in_proportion():
    pieces = ["<div>", "<a b='", "<!--", "</p>", "<b>", "=", "&", "<p>x", "<i></b>", "<td>x</div>", "<table><p>"]
    for piece in pieces:
        start = time.monotonic()
        text_of("<article>" + piece * (400_000 // len(piece)))
        assert time.monotonic() - start < 15, piece


@pytest.fixture(scope="module")
def sites(spark):
    """Pages without an article: templates on one host, the same blocks rare on another one."""
    rows = []
    for i in range(20):
        words = " ".join(f"w{i}x{j}" for j in range(30))
        box = "<div class=k1><p>Sign up for letters</div>" if i % 2 else "<div class=k2><p>Read this first</div>"
        tail = "<p>Every page says so.</p><p>Some pages say so.</p>" if i < 8 else "<p>Every page says so.</p>"
        markup = f"<body><div><h2>Page {i}</h2><p>{words}</p>{tail}</div>{box}</body>"
        rows.append((i, f"http://one.example/{i}", markup))
        rows.append((100 + i, f"http://TWO{i}.example/", markup))
        rows.append((200 + i, f"page {i}", markup))
    # Copies of one page are one page.
    rows += [(300 + i, f"http://copies.example/{i}", "<body><div>a b</div><div>copied text here</div>") for i in range(9)]
    rows += [(400, None, None), (401, "http://one.example/x", None), (402, "http://one.example/y", ""), (None, None, "<p>n")]
    rows += [rows[0]]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    return table.withColumns({c: F.lit("x") for c in ("text", "host", "page", "digest", "markup", "subtree", "strict")})


def expected_text(i, template):
    words = " ".join(f"w{i}x{j}" for j in range(30))
    lines = [f"Page {i}", words, "Every page says so."] + ["Some pages say so."] * (i < 8)
    if template:
        lines.remove("Every page says so.")
    else:
        lines.append("Sign up for letters" if i % 2 else "Read this first")
    return "\n".join(lines)


@pytest.mark.parametrize("handed_out", [hx.HANDED_OUT, 0])
def test_templates_of_a_host(sites, handed_out):
    found = [(r.page.page_id, r.page.url, r.text) for r in hx.extract_text(sites, handed_out=handed_out).collect()]
    assert len(found) == sites.count()
    texts = {i: t for i, _, t in found}
    for i in range(20):
        assert texts[i] == expected_text(i, True)
        assert texts[100 + i] == texts[200 + i] == expected_text(i, False)
    for i in range(9):
        assert texts[300 + i] == "a b\ncopied text here"
    assert (texts[400], texts[401], texts[402], texts[None]) == ("", "", "", "n")
    assert sum(i == 0 for i, _, _ in found) == 2


def test_sentences_in_articles_are_no_templates(spark):
    rows = [
        (i, "http://a.example/", f"<article><h1>T{i}</h1><p>x{i} y{i}</p><p>Said on every page.</p>"
         f"<div class=k>Join us</div></article><div class=q>All rights {i}</div>")
        for i in range(12)
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for r in hx.extract_text(pages).collect():
        assert r.text == f"T{r.page.page_id}\nx{r.page.page_id} y{r.page.page_id}\nSaid on every page."


def test_empty_table(sites):
    assert hx.extract_text(sites.limit(0)).count() == 0
    assert hx.extract_text(sites.limit(0)).select("page.*").columns == sites.columns


def test_hosts(spark):
    urls = ["http://A.b/c", "a.b/c", None, "x://y://z", "s://Q?u", "s://q#u", "s://u:1@h:2/"]
    table = spark.createDataFrame([(u,) for u in urls], "url string")
    assert [r[0] for r in table.select(hx.host_of(F.col("url"))).collect()] == ["a.b", "", "", "y:", "q", "q", "u:1@h:2"]
