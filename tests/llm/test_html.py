"""Main text of made pages, and of markup that isn't well formed."""

import html
import re
import time
from pathlib import Path

import pyarrow.parquet as pq
import pytest

from lipika.llm import line_blocks as B

LONG = "This is a paragraph of the article that goes on for long enough to be one, with a comma or two."
OTHER = "Another part of the text follows here, and it too says what articles say when they are read."


def test_article_element():
    page = f"""<html><head><title>T</title><script>var a = "</p>";</script><style>p{{}}</style></head><body><header><h2>Site</h2></header><nav><a href="/">Home</a></nav>
    <div class="ad">{OTHER}</div><article class="post"><header><h1>Head &amp; shoulders</h1></header><p><b>{LONG}<br>x&nbsp;y<p>ok</p><!-- {OTHER} --><aside>{OTHER}</aside><form><p>{OTHER}</p></form>
    <ul><li>one</li><li>two</li></ul><div id="comments"><p>{OTHER}</p></div></article><footer>&copy; {OTHER}</footer></body></html>"""
    assert B.main_text(page) == f"Head & shoulders {LONG} x y ok one two"


def test_without_article_the_distribution_decides():
    page = f"<body><div class='top menu'><a>{OTHER}</a></div><div><p>{LONG}</p><p>short</p><p>{OTHER}</p></div><div><a href=x>{LONG}</a></div><p hidden>{LONG}</p><div class=cookie-notice>{OTHER}</div></body>"
    assert B.main_text(page) == f"{LONG} short {OTHER}"


def test_boundaries_and_references():
    assert B.main_text("<article><p>a<b>b</b>c</p><p>&#233;&eacute;&lt;p&gt;  d\n e</p></article>") == "abc éé<p> d e"
    assert B.main_text("<article><div>one</div>two<div>three</div></article>") == "one two three"


def test_odd_pages():
    for page in (None, "", "   ", "<", "<<<>>>", "<!-- never closed", "<script>never closed", "<p", "<article></article>", "<nav>only</nav>"):
        assert isinstance(B.main_text(page), str)
    assert B.main_text(None) == "" and B.main_text("<nav>only</nav>") == ""
    assert B.main_text("plain text") == "plain text"
    assert B.main_text(f"<article><p>{LONG}") == LONG
    assert B.main_text(f"<nav><ul><li>menu<article><p>{LONG}</p></article>") == LONG


def test_an_article_element_is_judged_and_only_adds_weight():
    reader = "<li class='comment'><article class='comment-body'><p>A reader says this, and says it at some length, so that it weighs.</p></article></li>"
    assert B.main_text(f"<div class='entry-content'><p>{LONG}</p><p>{OTHER}</p></div><ol class='comment-list'>{reader}{reader}</ol>") == f"{LONG} {OTHER}"
    assert B.main_text("<div class='entry-content'><p>main text</p></div><ol class='comment-list'><li class='comment'><article class='comment-body'><p>reader</p></article></li></ol>") == "main text"
    plain = "<article><p>A reader says this, and says it at some length.</p></article>"
    assert B.main_text(f"<div><p>{LONG}</p></div><section class='blog-comments'>{plain}</section><aside>{plain}</aside><div class='related'>{plain}</div>") == LONG
    assert B.main_text(f"<div><p>{LONG}</p><p>{OTHER}</p></div><div><article class='card'><a href=x>Another page of this site</a></article></div>") == f"{LONG} {OTHER}"
    # text outside an article isn't lost, nor an article in a layout whose name holds a listed word
    assert B.main_text(f"<div><p>{LONG}</p></div><article><p>{OTHER}</p></article>") == f"{LONG} {OTHER}"
    for layout in ("div class='page has-sidebar'", "div class='header-fixed'", "div id='comments-open'", "form id='aspnet'"):
        assert B.main_text(f"<{layout}><h1>Title</h1><article><h2>Head</h2><p>{LONG}</p></article></{layout.split()[0]}>") == f"Title Head {LONG}"
    assert B.main_text(f"<article class='post category-legal tag-social'><p>{LONG}</p></article>") == LONG
    assert B.main_text(f"<aside><div>x<main><p>{LONG}</p></main>") == LONG


def test_nothing_between_first_surge_and_last_dive_is_lost():
    long = [f"Paragraph {k} " + "of three hundred characters or so goes on and on. " * 6 for k in range(12)]
    long = [x.strip() for x in long]
    p = [f"<p>{x}</p>" for x in long]
    advert = "<div class='ad'><p>Buy</p><p>this</p><p>now</p><p>!</p></div>"
    form = "<form><p>Your</p><p>name</p><p>here</p></form>"
    links = "".join(f"<p><a href={k}>See also part {k}</a></p>" for k in range(5))
    shown = " ".join(f"See also part {k}" for k in range(5))
    for block, kept in ((advert, ""), (form, ""), (links, shown + " ")):
        assert B.main_text(f"<div>{''.join(p[:10])}{block}{''.join(p[10:])}</div>") == f"{' '.join(long[:10])} {kept}{' '.join(long[10:])}"
    assert B.main_text(f"<div>{''.join(p)}{advert}<p>The end.</p></div>") == f"{' '.join(long)} The end."
    assert B.main_text(f"<div>{''.join(p)}{links}{p[0]}</div>{links}") == f"{' '.join(long)} {shown} {long[0]}"
    assert B.main_text(f"<head><title>T</title><body><p>{LONG}</p>") == LONG


def test_inside_an_article_only_whole_classes_name_boilerplate():
    for element in ("section id='related-work'", "section id='comments'", "section class='legal-basis'", "h2 id='search-trees'", "h2 id='search'", "span class='forms-of-energy'", "span id='sidebar'", "div class='social-impact'", "div id='search-trees'", "p class='notice'"):
        name = element.split()[0]
        assert B.main_text(f"<article><p>{LONG}</p><{element}>Kept text.</{name}><p>End.</p></article>") == f"{LONG} Kept text. End.", element
    for element in ("div class='comments'", "div class='x share-buttons'", "div class='ad'", "section class='comments_area'", "span class='sponsored'", "div id='comments'", "ul class='related-posts'", "div role='search'"):
        name = element.split()[0]
        assert B.main_text(f"<article><p>{LONG}</p><{element}>Dropped text.</{name}><p>End.</p></article>") == f"{LONG} End.", element


def test_raw_elements_end():
    for tag in ("<svg-icon name='x'></svg-icon>", "<video-player src=x></video-player>", "<select-box>", "<svg class='icon'/>", "<math/>", "<svg><title/><path d='z'/></svg>", "<svg><svg>a</svg>b</svg>", "<svg class='icon-search'>", "<iframe src=x>", "<!-->", "<script>a</script >"):
        assert B.main_text(f"<article><p>One.</p>{tag}<p>Two, the rest.</p></article>") == "One. Two, the rest.", tag
    assert B.main_text("<article><p>One.</p><svg-icon></svg-icon><p>Two.</p><svg><text>x</text></svg><p>Three.</p></article>") == "One. Two. Three."
    assert B.main_text("<article><p>One.</p><video src=x><p>Two.</p><video>old browser</video><p>Three.</p></article>") == "One. Two. Three."
    assert B.main_text("<article><p>One.</p><style>never closed <p>Two.</p></article>") == "One."


def test_unclosed_skipped_elements_take_linear_time():
    B.main_text("<article>" + "<svg>" * 100_000 + LONG)


def test_long_pages_take_linear_time():
    assert len(B.main_text("<article><p>" + "word " * 400_000 + "</p></article>")) == 5 * 400_000 - 1
    B.main_text("<div " * 100_000)
    B.main_text("<a href=\"" * 50_000)
    B.main_text("<!--" * 100_000)
    B.main_text("<article>" + "<div>" * 3000 + LONG)


def test_wrappers_headings_and_comments():
    for wrapper in ("div id='page' class='no-sidebar'", "form id='aspnetForm'", "div class='search-page'"):
        assert B.main_text(f"<body><{wrapper}><div><p>{LONG}</p><p>{OTHER}</p></div></{wrapper.split()[0]}><div class='sidebar'>{LONG}</div></body>") == f"{LONG} {OTHER}", wrapper
    assert B.main_text(f"<div class='entry'><p>{LONG}</p><div class='search-results-discussion'><p>{OTHER}</p></div></div><div class='search-form'>{OTHER}</div>") == f"{LONG} {OTHER}"
    assert B.main_text(f"<div class='post'><div class='post-header'><h1>Heading</h1></div><p>{LONG}</p></div>") == f"Heading {LONG}"
    assert B.main_text(f"<h1>Title</h1><p>By X</p><p>{LONG}</p><p>See <a href=x>the other long text that is linked</a>.</p><p>{OTHER}</p>") == f"Title By X {LONG} See the other long text that is linked. {OTHER}"
    links = "<p><a href=1>a link</a></p>" * 3
    assert B.main_text(f"<div><p>{LONG}</p>{links}<p>Final words.</p></div>{links}<p>Foot</p>") == f"{LONG} a link a link a link Final words."
    assert B.main_text(f"<article><p>{LONG}</p></article><div><article id='comment-3'><p>{OTHER}</p></article></div><div class='related'><article><p>{OTHER}</p></article></div>") == LONG
    assert B.main_text(f"<article><p>{LONG}</p></article><div class='comments'>{f'<p>{OTHER}</p>' * 5}</div>") == LONG


def test_against_a_plain_cut_of_the_pages():
    tables = Path("/root/testdata/sf0.001/pages.parquet")
    if not tables.exists():
        pytest.skip("no test data")
    for page in pq.read_table(tables).column("html").to_pylist():
        cut = re.search(r"<article>(.*)</article>", page, re.S)[1]
        blocks = [html.unescape(re.sub(r"<[^>]*>", "", x)) for x in re.split(r"</?(?:p|h1|li|ul)\b[^>]*>", re.sub("<br>", " ", cut))]
        assert B.main_text(page) == " ".join(" ".join(x.split()) for x in blocks if x.strip())


@pytest.mark.parametrize("unit", ["<script ", "<![CDATA[", "<a b=\"", "<p ", "<div><section></aside>", "<!--", "<svg>", "<div class=ad><article>", "<div></section>", "<title ", "<a href='x>", "<article class=ad><form><article>"])
def test_hostile_markup_takes_linear_time(unit):
    def took(n):
        began = time.perf_counter()
        B.main_text(unit * n + "<p>text</p>" + LONG + "<" + "</section>" * n + "<" * n)
        return time.perf_counter() - began

    assert took(20_000) < 12 * took(5_000) + 0.5


def test_rows(spark):
    rows = [(1, "u", f"<article>{LONG}</article>", "x"), (1, "u", None, "x"), (None, None, "", "x")]
    found = B.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert sorted((str(r.page_id), r.text, r.n_chars) for r in found) == sorted([("1", LONG, len(LONG)), ("1", "", 0), ("None", "", 0)])
    assert B.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
