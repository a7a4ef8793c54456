"""Main text: minimum cuts against all labellings, and pages of many shapes."""

import itertools
import random
import time

import pytest

from medalith.llm import main_text as m


@pytest.mark.parametrize("seed", range(60))
def test_cut_is_minimal(seed):
    pick = random.Random(seed)
    size = pick.randint(1, 9)
    gains = [pick.uniform(-2, 2) for _ in range(size)]
    edges = [(a, b, pick.uniform(0, 1.5)) for a in range(size) for b in range(a) if pick.random() < 0.5]

    def cost(labels):
        own = sum(abs(g) for g, x in zip(gains, labels, strict=True) if x != (g > 0))
        return own + sum(w for a, b, w in edges if labels[a] != labels[b])

    best = min(cost(x) for x in itertools.product([False, True], repeat=size))
    assert cost(m.minimum_cut(gains, edges)) == pytest.approx(best)


ARTICLE = "<article><h1>A title</h1><p>First paragraph, with some words.<p>Second   one &amp; more&nbsp;text &lt;here&gt;.</article>"
TEXT = "A title\n\nFirst paragraph, with some words.\n\nSecond one & more text <here>."
PAGES = [
    (1, f"<html><head><title>T</title><style>p{{}}</style></head><body><nav><ul><li><a href=x>Home</a><li>About</ul></nav>{ARTICLE}<footer>&copy; me</footer>", TEXT),
    (2, None, ""),
    (3, "", ""),
    (4, "<nav>Menu</nav><div class='ad'>Buy this now, it is cheap.</div>", ""),
    (5, f"<body><header><p>A header line of the site.</p></header><main>{ARTICLE}<script>var t='</p>'</script></main><aside>See also that.</aside>", TEXT),
    (6, f"<div class='cookie-notice'>We use cookies. Accept them.</div>{ARTICLE}<form><p>Sign up for mails, please.</p><input></form>"
        "<section id='comments'><h2>Comments</h2><article><p>A reader wrote this long comment, it seems.</p></article></section>", TEXT),
    (7, "<p>only & text &am", "only & text &am"),
    (8, "<article><p><b>Bold<br>line<p>next paragraph<br/>goes on.<!-- c --></b></article>", "Bold line\n\nnext paragraph goes on."),
    (9, "<article><div class=sidebar><p>Popular things of today.</p></div><p>The text, as it is.</p></article>", "The text, as it is."),
    (10, "<article>" + "<p>Some text of a paragraph, again.</p>" * 3000 + "</article>", "\n\n".join(["Some text of a paragraph, again."] * 3000)),
    (10, "<article><p>Broken <![if x]> declaration and </stray> tag.", "Broken declaration and tag."),
]


def test_pages(spark):
    pages = spark.createDataFrame([(p, h) for p, h, _ in PAGES if p != 7], "page_id long, html string")
    found = m.with_main_text(spark, pages).collect()
    assert [(r.page_id, r.text) for r in found] == [(p, t) for p, _, t in PAGES if p != 7]


def test_given_pages(spark):
    """The given pages keep everything inside of the article element and nothing else."""
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    weights = m.fit(pages)
    found = m.with_main_text(spark, pages, into="html_text", weights=weights).collect()
    assert found and all(r.html_text.startswith(m.page_blocks("<h1>" + r.html.split("<h1>")[1].split("</h1>")[0] + "</h1>")[0].text) for r in found)
    assert not any("&copy;" in r.html_text or "©" in r.html_text for r in found)


def test_pages_without_telling_markup(spark):
    weights = m.fit(spark.read.parquet("/root/testdata/sf0.001/pages.parquet"))
    long = "This is a sentence of a real text that goes on for a while, and it has commas. " * 4
    page = f"<div><a href=1>One</a> <a href=2>Two</a></div><div><div>{long}</div><div>{long}</div></div><div><a href=3>Contact</a></div>"
    assert m.main_text(page, [float(w) for w in weights]) == "\n\n".join([long.strip()] * 2)


def test_empty_table_and_other_columns(spark):
    assert m.with_main_text(spark, spark.createDataFrame([], "page_id long, html string")).count() == 0
    pages = spark.createDataFrame([(1, ARTICLE, "r", "l")], "page_id long, html string, rows string, labels string")
    assert [tuple(r) for r in m.with_main_text(spark, pages).select("text", "rows", "labels").collect()] == [(TEXT, "r", "l")]


def test_copies_of_a_page_do_not_empty_the_sample(spark):
    made = [(k, f"<article><p>Text {k % 4} goes on here.</p></article><div class=ad>Buy {k % 4}</div>") for k in range(4000)]
    pages = spark.createDataFrame(made, "page_id long, html string")
    one = m.fit(pages.dropDuplicates(["html"]), sample=4)
    assert m.fit(pages, sample=4).tolist() == pytest.approx(one.tolist())


@pytest.mark.parametrize("page", [
    f"<div class='content no-sidebar'>{ARTICLE}</div>",
    ARTICLE.replace("<article>", "<article class='post comments-open'>"),
    f"<div id='page' class='header-fixed'>{ARTICLE}</div>",
    f"<div class='header'>{ARTICLE}</div>",
    f"<div class='sidebar'><main>{ARTICLE}</main></div>",
    f"<html><head><meta charset='utf-8'><title>T</title><body>{ARTICLE}",
    f"<html><head><meta charset='utf-8'><title>T</title>{ARTICLE}",
    f"<body><form id='aspnetForm' action='x'><div class='top'>{ARTICLE}</div></form>",
    "<form id='aspnetForm'><nav>Home</nav>" + ARTICLE.replace("article", "div").replace("<div>", "<div id='main-content'>") + "<footer>Me</footer></form>",
    ARTICLE.replace("<h1>A title</h1>", "<header class='entry-header'><h1>A title</h1></header>"),
    ARTICLE.replace("<h1>A title</h1>", "<div class='page-header'><h1>A title</h1></div>"),
    f"<div class='site-header'><p>A long line about this site, as a sentence.</p></div>{ARTICLE}",
    f"{ARTICLE}<div class='site-footer'><p>A long line about this site, as a sentence.</p></div>",
    f"<div class='cookie-bar'><p>We keep cookies of yours, if you let us do so.</p></div>{ARTICLE}",
    f"{ARTICLE}<div id='disqus_thread'><article><p>A reader wrote this long comment, it seems.</p></article></div>",
    f"{ARTICLE}<div class='related-content'><article><p>Another story that you may like, it seems.</p></article></div>",
    f"<div id='siteHeader'><p>A long line about this site, as a sentence.</p></div>{ARTICLE}<form class='search-form'><p>Look for it here, please.</p></form>",
    f"<div class='content-sidebar-wrap'>{ARTICLE}<div class='sidebar-right'><p>Popular things of today, all of them.</p></div></div>",
    f"<main><header><h1>A title</h1></header>{ARTICLE.replace('<h1>A title</h1>', '')}</main>",
])
def test_ordinary_markup_keeps_the_article(page):
    prior = [-1.0, 0.4, -3.0, 0.8, 0.5, -0.5, 5.0, -8.0, -0.7, 0.7]
    assert m.main_text(page, prior[: m.FEATURES]) == TEXT


def test_text_ends_an_open_head():
    assert [b.text for b in m.page_blocks("<html><head><title>T</title>Some text.<p>More.")] == ["Some text.", "More."]
    assert [b.text for b in m.page_blocks("<html><head><noscript><img src=x></noscript><style>p{}</style></head><p>More.")] == ["More."]


def test_deep_nesting_takes_no_room_by_depth():
    page = "<article>" + "".join(f"<div>A sentence of level {k}, it is." for k in range(20_000)) + "</span>" * 20_000
    begin = time.monotonic()
    blocks = m.page_blocks(page)
    assert len(blocks) == 20_000 and all(b.side == 1 for b in blocks) and len(m.smooth_edges(blocks)) >= 19_999
    assert time.monotonic() - begin < 20
