"""Main text against the articles cut out by pattern; alignment against its definition."""

import random
import re
import time
from html import unescape

import pytest

from termpeak.llm.html_extract import Wrapper, align, blocks, extract_text, extraction_query, slots_of
from termpeak.llm.html_tree import Node, parse


def by_pattern(html):
    """The given pages hold one article of headings and paragraphs."""
    own = re.search(r"<article>(.*?)</article>", html, re.S).group(1)
    parts = re.split(r"</?(?:h1|p)>", own)
    texts = [" ".join(unescape(re.sub(r"<[^>]*>", " " if "<br" in p else "", p)).split()) for p in parts]
    return "\n".join(t for t in texts if t)


def test_whole_small_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    expected = sorted((r["page_id"], r["url"], by_pattern(r["html"])) for r in pages.collect())
    got = sorted(tuple(r) for r in extraction_query(pages).collect())
    assert [g[:3] for g in got] == expected
    assert all(g[3] == len(g[2]) for g in got)


ARTICLE = """<!doctype html><html><head><title>T</title><style>p{}</style></head><body>
<header class=top><h1>Site</h1></header><NAV><ul><li><a>One</a><li><a>Two</a></ul></NAV>
<div id="cookieNotice">We use cookies</div><main><article class="post">
<header><h1>Fish &amp; chips&#33;</h1></header><p>First   <b>bold
text</b><br>goes on<script>var a="</p>";</script><p>Second &lt;tag&gt; &nbsp; end
<ul><li>point one<li>point two</ul><table><tr><td>x<td>y</table><blockquote>said</blockquote>
<form>Sign up <input></form><div class="share-buttons">Share</div><aside>Aside</aside>
<section class="comments"><h2>Comments</h2><p>Nice</p></section></article></main>
<div class="sidebar">Side</div><footer>&copy; 2020</footer>"""


def test_article_without_all_the_rest():
    assert Wrapper("").text_of(ARTICLE) == "\n".join(
        ["Fish & chips!", "First bold text goes on", "Second <tag> end", "point one", "point two", "x", "y", "said"]
    )


def test_words_about_the_layout_and_articles_that_are_none():
    html = """<body class="has-sidebar"><div class="page-with-sidebar"><main class="with-menu">
<article class="post has-banner"><p>Text</p><p style="display: none">unseen</p>
<article class="comment"><p>Reader</p></article></article>
<article class="teaser related"><p>A longer text about something else entirely</p></article></main></div>"""
    assert Wrapper("").text_of(html) == "Text"


def page_of(k, body):
    return f"""<html><body><div class="head"><p>The Daily Page</p></div><div class="wrap"><div class="text">
<p>Story {k} begins here and has a good many words of its own.</p><p>{body}</p><p>Read our terms before you copy.</p>
</div><div class="extra"><p>Call us any time.</p></div></div><div class="end"><p>All pages end so</p></div></body></html>"""


@pytest.mark.parametrize("most", [0, 1 << 25])
def test_constant_leaves_are_template_where_no_article_is_marked(spark, monkeypatch, most):
    monkeypatch.setattr("termpeak.llm.html_extract.BROADCAST_BYTES", most)
    rows = [(k, f"https://plain.example/{k}", page_of(k, f"Body {k * 17} differs on every page that there is.")) for k in range(9)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    rows = extract_text(pages).collect()
    assert sorted(r["page_id"] for r in rows) == list(range(9))
    for r in rows:
        lines = r["text"].split("\n")
        assert lines[0].startswith(f"Story {r['page_id']} begins") and f"Body {r['page_id'] * 17} " in lines[1]
        assert "The Daily Page" not in r["text"] and "Call us" not in r["text"] and "All pages" not in r["text"]


def brute_match(a, b):
    """Simple tree matching by its recursion."""
    if a.label != b.label:
        return 0

    def best(i, j):
        if i == len(a.kids) or j == len(b.kids):
            return 0
        return max(best(i + 1, j), best(i, j + 1), brute_match(a.kids[i], b.kids[j]) + best(i + 1, j + 1))

    return 1 + best(0, 0)


def random_page(draw, depth=0):
    parts = []
    for _ in range(draw.randint(0, 3)):
        tag = draw.choice(["div", "section", "p", "h2"])
        inner = random_page(draw, depth + 1) if depth < 3 and tag in ("div", "section") else "text"
        parts.append(f"<{tag}>{inner}</{tag}>")
    return "".join(parts)


def test_alignment_is_the_largest_match():
    draw = random.Random(4)
    for _ in range(150):
        one, two = (slots_of(parse(random_page(draw))) for _ in range(2))
        found = align(one[0], two[0])
        assert len(found) == brute_match(one[0], two[0])
        assert all(one[k].label == s.label for k, s in found.items())


@pytest.mark.parametrize(
    "html, text",
    [
        ("", ""), ("just text &amp; more", "just text & more"), ("<p>open<p>again", "open\nagain"), ("a < b and c", "a < b and c"),
        ("<div><div></div></div>", ""), ("<!-- x --><p>after</p><!-- not ended <p>no", "after"), ("<p title='>'>quoted</p>", "quoted"),
        ("<script>never ends", ""), ("</p></div>stray<i>x</b></i>", "strayx"),
        ("<div>" * 5000 + "deep", "deep"), ("<p>word</p>" * 20000, "\n".join(["word"] * 20000)),
    ],
)
def test_odd_markup(html, text):
    assert Wrapper("").text_of(html) == text
    assert Wrapper(html).text_of(html) == text


def test_wide_pages_are_matched_in_order():
    html = "".join(f"<div class=c{k}><p>t{k}</p>more</div>" for k in range(400))
    assert len(align(slots_of(parse(html))[0], slots_of(parse(html))[0])) == 801


def test_blocks_are_in_page_order():
    assert blocks([parse("a<p>b</p>c<h2>d</h2>")]) == ["a", "b", "c", "d"]
    assert isinstance(parse("<p>x").children[0], Node)


def test_odd_rows(spark):
    rows = [(1, None, None, "x"), (2, "no url", "<p>p</p>", "x"), (2, "no url", "<p>p</p>", "x"), (None, "http://h/", "", "x"), (3, "http://H/a", "<p>q</p>", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(((r[0] or 0, r[1] or "", r[2], r[3]) for r in extraction_query(pages).collect()))
    assert got == [(0, "http://h/", "", 0), (1, "", "", 0), (2, "no url", "p", 1), (2, "no url", "p", 1), (3, "http://H/a", "q", 1)]
    assert extraction_query(pages.limit(0)).count() == 0


def text_of(html):
    return Wrapper("").text_of(html)


LONG = "Much of what this page has to say stands in this paragraph, and more would follow."


@pytest.mark.parametrize(
    "html, text",
    [
        (f"<main><h1>Title</h1><p>Lead</p><article><p>{LONG}</p></article><p>End</p></main>", f"Title\nLead\n{LONG}\nEnd"),
        (f"<article class=a><p>One</p></article><hr><article class=b><p>{LONG}</p></article>", f"One\n{LONG}"),
        (f"<nav>menu</nav><h1>Title</h1><article><p>{LONG}</p></article>", f"Title\n{LONG}"),
        (f"<h1>Site</h1><article><h1>Own</h1><p>{LONG}</p></article>", f"Own\n{LONG}"),
        (f'<div class="container sidebar-right"><article><p>{LONG}</p></article></div>', LONG),
        (f'<div class="entry comments-open"><article><p>{LONG}</p></article></div>', LONG),
        (f'<form id="aspnetForm"><article><p>{LONG}</p></article></form>', LONG),
        (f'<form id="aspnetForm"><div><p>{LONG}</p></div></form>', LONG),
        (f'<div class="container sidebar-right"><p>{LONG}</p></div><footer>x</footer>', LONG),
        (f'<article><p>{LONG}</p><div class="related-work">Others</div><table class="share-price-table"><tr><td>7</table>'
         '<div class="notice-of-law">Law</div><div class="related-posts">Not this</div></article>', f"{LONG}\nOthers\n7\nLaw"),
        (f'<article><p>Short</p></article><div class="comments"><p>{LONG}</p><article class=comment>{LONG}</article></div>', "Short"),
        (f'<p>{LONG}</p><div class="comments"><p>{LONG} {LONG} {LONG}</p></div>', LONG),
        (f'<article><p>{LONG}</p></article><div class="related-posts"><article><p>Teaser</p></article></div>', LONG),
        ("<div>" * 70 + f"<div><article><p>{LONG}</p></article></div><div>junk beside it</div>", LONG),
        ("".join(f"<div class=w{k}><p>t{k}</p>" for k in range(70)) + f"<article><p>{LONG}</p></article>", LONG),
    ],
)
def test_regions(html, text):
    for page in (html, f"<html><body>{html}</body></html>"):
        assert text_of(page) == text
        assert Wrapper(page).text_of(page) == text


def test_an_article_that_is_template_goes_where_another_varies(spark):
    rows = [
        (k, f"https://h.example/{k}", f"<article class=letter><p>Read our letter today.</p></article><article><p>Story {k} {LONG}</p></article>")
        for k in range(5)
    ] + [(9, "https://h.example/9", "<article class=letter><p>Read our letter today.</p></article>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in extract_text(pages).collect()}
    assert got == {k: f"Story {k} {LONG}" for k in range(5)} | {9: "Read our letter today."}


@pytest.mark.parametrize("odd", ["", "   ", None, "<div></div>", "<p>Error 500</p>"])
def test_an_odd_page_of_the_host_changes_nothing(spark, odd):
    rows = [(k, f"https://plain.example/{k}", page_of(k, f"Body {k * 17} differs on every page.")) for k in range(9)]
    rows += [(100 + k, f"https://plain.example/odd{k}", odd) for k in range(2)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    texts = {r["page_id"]: r["text"] for r in extract_text(pages).collect()}
    for k in range(9):
        assert texts[k].startswith(f"Story {k} begins") and "The Daily Page" not in texts[k]


@pytest.mark.parametrize("width", [30, 251, 700])
def test_wide_lists_are_matched_exactly(width):
    """One of many children moved from front to back: all others still match."""
    kids = [f"<div class=c{k}><p>t{k}</p><ul><li>x</ul></div>" for k in range(width)]
    one, two = slots_of(parse("".join(kids))), slots_of(parse("".join(kids[1:] + kids[:1])))
    assert len(align(one[0], two[0])) == 1 + 3 * (width - 1)


def test_matching_in_halves_is_the_largest_match(monkeypatch):
    monkeypatch.setattr("termpeak.llm.html_extract.TABLE", 0)
    draw = random.Random(9)
    for _ in range(150):
        one, two = (slots_of(parse(random_page(draw))) for _ in range(2))
        assert len(align(one[0], two[0])) == brute_match(one[0], two[0])


@pytest.mark.parametrize(
    "unit, more", [("<a ", ""), ("<a x=\"", ""), ("<a x=\">'", '"'), ("<p title='>", ""), ("<div>", ""), ("<div><p>", ""), ("<", ""),
                   ("<!-- ", ""), ("<li><b>", ""), ("<i ", ">"), ("</b>", "<"), ("&amp", "")]
)
def test_a_megabyte_of_broken_tags_parses_in_seconds(unit, more):
    start = time.perf_counter()
    parse(unit * (1_000_000 // len(unit)) + more)
    assert time.perf_counter() - start < 20


def test_deep_pages_are_aligned_to_the_bottom():
    def page(text):
        return "".join(f"<div class=d{k}><p>n{k}</p>" for k in range(900)) + f"<section><p>{text}</p></section>"

    # the section and its one paragraph are one slot
    assert len(align(slots_of(parse(page("a")))[0], slots_of(parse(page("b")))[0])) == 1 + 1800 + 1
    assert text_of(page("a")).endswith("n899\na")
