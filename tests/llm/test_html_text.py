from __future__ import annotations

import re
import time
from html import unescape

import pytest
from starloom.llm import html_text
from starloom.llm.html_text import Page
from starloom.llm.queries import QUERIES

FRAME = (
    '<html><head><title>T</title><style>p{}</style></head><body class="has-sidebar"><header>Site</header>'
    '<nav><a href=x>Home</a></nav><div class="cookie-notice">We use cookies</div>%s<aside>side</aside><footer>foot</footer></body></html>'
)


@pytest.mark.parametrize(
    ("article", "blocks"),
    [
        ("<article><h1>A &amp; B</h1><p>one\n  two&nbsp;three<p>four<br>five</article>", ["A & B", "one two three", "four five"]),
        ("<div id=main><div class='post-content'><p>one</p>two<ul><li>a<li>b</ul></div></div>", ["one", "two", "a", "b"]),
        ("<article><p>x</p><div class='ad-slot'>buy</div><form>name<input></form><p>y</p></article>", ["x", "y"]),
        ("<article><p>x<b>bold</b>y</p><section class=comments><p>nice</p></section><div id=commentList>so</div></article>", ["xboldy"]),
        ("<article><p>x<script>var a='</p>';</script>y<!-- <p>no</p> --></p><noscript>n</noscript></article>", ["xy"]),
        ("<main><section><p>one</p></section><section><p>two</p></section></main>", ["one", "two"]),
        ("<article><p>1 &lt; 2 &#8212; &eacute;</p><p hidden>h</p><p style='display: none'>n</p></article>", ["1 < 2 — é"]),
        ("<article><table><tr><td>a</td><td>b</td></tr><tr><td>c</td></tr></table></article>", ["a", "b", "c"]),
        ("<article><p title='a>b'>q</p><div class='no-sidebar'>kept</div></article>", ["q", "kept"]),
        ("<article><p>a</p><ol class='commentlist'><li>nice</ol><div class='subscribeBox'>mail</div></article>", ["a"]),
        ("<form id=f><input type=hidden><article><p>a</p><form>b</form></article></form>", ["a"]),
        ("<article><p>a longer text</p></article><form><p>b</p></form><h1>x</h1>", ["a longer text"]),
        ("", []),
    ],
)
def test_page(article, blocks):
    assert Page(FRAME % article).text(None) == "\n\n".join(blocks)


@pytest.mark.parametrize("html", ["", "just text", "<p>open", "</p></div>", "<", "<a href='x>y", "<!-- open", "<script>open", "<div>" * 3000 + "x"])
def test_broken_pages(html):
    page = Page(html)
    page.scores()
    assert page.text(None) in ("", "just text", "open", "<", "y", "x")


def test_hosts_agree_on_a_path(spark):
    """One page has a longer list beside its article; the other pages of the host settle where the article is."""
    page = '<body><div class="teasers t%d">%s</div><div class="inner">%s</div></body>'
    odd = page % (9, "<p>teaser text</p>" * 30, "<p>short article</p>")
    rows = [(i, f"http://h.net/{i}", page % (i, "<p>teaser</p>", f"<p>{'article text ' * 20}</p>")) for i in range(6)]
    frame = spark.createDataFrame([*rows, (6, "http://h.net/6", odd), (7, "http://other.net/", odd)], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_text.extracted(frame).collect()}
    assert got[6] == "short article" and got[7].startswith("teaser text")
    assert all("teaser" not in got[i] for i in range(6))


def test_query(spark, sf_dir):
    """The test pages hold one article each, in flat paragraphs."""
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    got = QUERIES["op10_html_text"](spark, sf_dir).collect()
    assert len(got) == len(pages)
    for r in got:
        article = re.search(r"<article>(.*)</article>", pages[r["page_id"]]["html"], re.S)[1]
        parts = [" ".join(unescape(re.sub(r"<[^>]*>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        assert r["text"] == "\n\n".join(p for p in parts if p)
        assert r["n_chars"] == len(r["text"]) and r["url"] == pages[r["page_id"]]["url"]


def test_messy(spark):
    rows = [
        (1, None, None, "x"),
        (1, None, None, "x"),
        (None, "http://a/", "<article><p>t</p></article>", None),
        (2, "no host", "<article>" + "<p>long text</p>" * 20_000 + "</article>", "x"),
        (3, "http://a/", "", "x"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_text.extracted(pages).collect()
    assert sorted((r["page_id"] or 0, r["n_chars"]) for r in got) == [(0, 1), (1, 0), (1, 0), (2, 20_000 * 11 - 2), (3, 0)]
    assert html_text.extracted(pages.limit(0)).count() == 0


BODY = "<p>" + "body text " * 60 + "</p>"


@pytest.mark.parametrize(
    ("page", "blocks"),
    [
        ("<article><h1>title</h1><p>lead</p><div class='entry-content'>%s</div><p>end</p></article>", ["title", "lead", 0, "end"]),
        ("<main><h1>title</h1><div class=content><div class=text>%s</div></div></main>", ["title", 0]),
        ("<div class=post><h1>title</h1><p>lead</p><div class='entry-content'>%s</div></div>", ["title", "lead", 0]),
        ("<main><h1>title</h1><article>%s</article></main>", ["title", 0]),
        ("<main><p><a href=x>more of this</a></p><article>%s</article></main>", [0]),
        ("<main><p>top</p><article>%s</article><article class=card>other</article></main>", [0]),
        ("<p>outside</p><article><p>lead</p><div class='entry-content'>%s</div><div class=tags><a href=x>tag</a></div></article>", ["lead", 0, "tag"]),
    ],
)
def test_text_beside_an_inner_container(page, blocks):
    assert Page(FRAME % (page % BODY)).text(None) == "\n\n".join(b or " ".join(["body text"] * 60) for b in blocks)


def test_title_and_lead_outside_the_content_container(spark):
    """The inner container wins the vote of the host; the article is whole also where most of it is the lead."""
    page = "<body><article><h1>title</h1><p>%s</p><div class='entry-content'>%s</div><p>end</p></article></body>"
    rows = [(i, f"http://h.net/{i}", page % ("lead", BODY)) for i in range(20)] + [(20, "http://h.net/20", page % ("lead " * 100, "<p>body</p>"))]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert html_text.winning_paths(frame).first()["path"].endswith("div.entry-content")
    got = {r["page_id"]: r["text"].split("\n\n") for r in html_text.extracted(frame).collect()}
    assert got[0] == ["title", "lead", " ".join(["body text"] * 60), "end"]
    assert got[20] == ["title", " ".join(["lead"] * 100), "body", "end"]


@pytest.mark.parametrize(
    ("page", "blocks"),
    [
        (f"<article><section id='{i}'><h2 id='{i}'>head</h2><p>kept</p></section></article>", ["head", "kept"])
        for i in ("related-work", "social-history", "search-algorithms", "form-and-function", "discussion")
    ]
    + [
        ("<article><h2 class='section-header'>head</h2><p class=notice>note <a class=share>it</a></p></article>", ["head", "note it"]),
        ("<article><div class='commentary'>on it</div><p>x</p></article>", ["on it", "x"]),
        ("<div class='layout sidebar-right'><article><p>one</p></article><div class='sidebar'>side</div></div>", ["one"]),
        ("<div class='layout sidebar-right'><main><p>one</p></main></div>", ["one"]),
        ("<div class='layout sidebar-right'><div><p>the first paragraph</p><p>the second paragraph</p></div></div>", ["the first paragraph", "the second paragraph"]),
        ("<div class=post><p>some words of a post</p></div><div class=comments><article class=comment>nice</article></div>", ["some words of a post"]),
        ("<article><p>a</p><div id=comments>so</div><ul class=commentlist><li>so</ul><div id=related-posts>so</div><div id=related-theories>kept</div></article>", ["a", "kept"]),
    ],
)
def test_names_that_are_no_furniture(page, blocks):
    assert Page(FRAME % page).text(None) == "\n\n".join(blocks)


@pytest.mark.parametrize(
    "block",
    [
        '<section class="related-work"><p>%s</p></section>',
        '<table class="search-results"><tr><td>%s</td></tr></table>',
        '<ul class="share-prices"><li>%s</li></ul>',
        '<div class="alert-levels"><p>%s</p></div>',
        '<div class="form-factor">%s</div>',
        '<ol class="menu-engineering"><li>%s</ol>',
        '<div class="cookie-recipe"><div><p>%s</p></div></div>',
        "<math><p>%s</p></math>",
        "<object data=x><p>%s</p></object>",
        '<div class="wrap"><section class="comment-culture"><ul class="list"><li>%s</ul></section></div>',
    ],
)
def test_article_blocks_stay(block):
    page = Page(FRAME % f"<article><p>before this block</p>{block % 'kept words'}<p>after this block</p></article>")
    assert page.text(None) == "before this block\n\nkept words\n\nafter this block"


@pytest.mark.parametrize(
    "block",
    [
        '<section class="related-posts"><p>%s</p></section>',
        '<div class="reader-comments"><p>%s</p></div>',
        '<ul class="share-buttons"><li>%s</li></ul>',
        '<div class="cookie-banner">%s</div>',
        '<div id="newsletterBox">%s</div>',
        "<aside>%s</aside>",
    ],
)
def test_furniture_in_articles_goes(block):
    page = Page(FRAME % f"<article><p>before this block</p>{block % 'dropped words'}<p>after this block</p></article>")
    assert page.text(None) == "before this block\n\nafter this block"


@pytest.mark.parametrize(
    "html",
    [
        "<a " * 300_000,
        "<a " * 300_000 + ">",
        '<a ">" ' * 140_000,
        "<script" * 140_000,
        "<!" * 500_000,
        "<a " + "x" * 1_000_000 + ">text</a>",
        "<a " + "x=" * 500_000 + ">text</a>",
        "<a " + "x " * 500_000 + ">text</a>",
        "<b>x" * 100_000 + "<hr>y" * 100_000,
        "<b>x" * 100_000 + "</i>y" * 100_000,
        "<p>" + "<b>x" * 100_000 + "<hr>y" * 100_000,
        "<form>" * 160_000,
        "<div><p>" * 100_000,
        "<li>" * 250_000,
        "&amp" * 250_000,
    ],
    ids=range(15),
)
def test_any_page_takes_linear_time(html):
    start = time.perf_counter()
    Page(html).text(None)
    Page(html).scores()
    assert time.perf_counter() - start < 20
