"""Main-text extraction: planted pages, a plain cut of the driver's pages, odd markup."""

import html
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from indicata.llm.html_text import extract, main_text

BODY = ["The council met on Monday, and the vote was, as expected, close.",
        "Members spoke for three hours; nobody, it seems, changed their mind.", "Short.",
        "A list follows, with more to read and to think about, before the end."]
PARAS = "".join(f"<p>{b}</p>" for b in BODY)


def plain(source):
    """The driver's pages: headings and paragraphs of the one article element."""
    article = re.search(r"<article>(.*)</article>", source, re.S)[1]
    parts = re.split(r"</?(?:p|h1)>", article.replace("<br>", " "))
    blocks = (" ".join(html.unescape(re.sub("<[^>]*>", "", p)).split()) for p in parts)
    return "\n\n".join(b for b in blocks if b)


def page(body, head=""):
    return f"<!DOCTYPE html><html><head><title>T</title>{head}</head><body>{body}</body></html>"


MENU = '<div><a href="/a">Home</a> | <a href="/b">World news</a> | <a href="/c">Sport</a></div>'
NOISE = ('<header><h1>The Daily Site</h1></header><nav><a href="/">Home</a></nav>' + MENU
         + '<div class="cookie-banner">We use cookies, and more cookies, and partners.</div>')
TAIL = ('<aside><p>Most read, today, this week, and ever.</p></aside><footer>All rights reserved</footer>'
        '<script>var x = "<p>no, no, no</p>";</script><style>p { color: red }</style>')
WANT = "\n\n".join(BODY)


@pytest.mark.parametrize("source", [
    page(NOISE + f"<article>{PARAS}</article>" + TAIL),
    page(NOISE + f"<main><div>{PARAS}</div></main>" + TAIL),
    page(NOISE + f'<div id="wrap"><div class="content">{PARAS}</div><div class="sidebar"><p>x, y, z.</p></div></div>' + TAIL),
    page(NOISE + f"<div><section>{PARAS}</section></div>" + TAIL),
    page(NOISE + f'<article>{PARAS}<div class="ad">Buy, buy, buy!</div><form><input> Your mail, please</form></article>' + TAIL),
    page(NOISE + f'<article>{PARAS}</article><section id="comments"><h2>2 comments</h2>'
         + "<p>First, of course, as always, me.</p>" * 40 + "</section>" + TAIL),
    page(NOISE + f"<article>{PARAS}</article><div><h3>Comments</h3>" + "<p>So good, so true, so long.</p>" * 30 + "</div>" + TAIL),
    page(NOISE + f'<article>{PARAS}</article><article class="comment"><p>Hm, well, no, I think not.</p></article>' + TAIL),
    page(NOISE + f'<article>{PARAS}<ul class="share"><li><a href="#">Share</a></li></ul>'
         '<ul><li><a href="1">More on this</a></li><li><a href="2">And that</a></li><li><a href="3">Or so</a></li></ul></article>'),
    page(NOISE + f'<article><!-- <p>gone</p> -->{PARAS}<p hidden>secret</p><div style="display: none">s</div></article>'),
    NOISE + f"<article>{PARAS}",  # no end tags
    page(f'<body class="has-sidebar"><div class="story">{PARAS}</div><div class="related-posts"><p>Other, older, things.</p></div>'),
    page("<table><tr><td><a href=1>One</a> <a href=2>Two</a> <a href=3>Three</a></td>"
         f"<td>{PARAS}</td></tr></table>"),
    page(NOISE + f'<div class="c">{"".join(f"<p>{b}</p>" for b in BODY[:2])}</div>'
         f'<div class="c">{"".join(f"<p>{b}</p>" for b in BODY[2:])}</div>' + TAIL),
])
def test_planted_pages(source):
    assert main_text(source) == WANT


def test_blocks_and_characters():
    source = page("<article><header><h1>Title &amp; more</h1></header><p>a <b>b</b>c<br>d &lt;i&gt; &#8364;&nbsp;5\n\t x"
                  "<p>second<ul><li>one<li>two <i>x</i></ul><pre>k\n  l</pre><blockquote>said<footer>who</footer></blockquote>"
                  "<table><tr><td>1<td>2<tr><td>3</table>tail <br> <br> end</article>")
    assert main_text(source).split("\n\n") == ["Title & more", "a bc d <i> € 5 x", "second", "one", "two x", "k l", "said",
                                               "who", "1", "2", "3", "tail", "end"]
    assert main_text("just  text, \n no markup &eacute;") == "just text, no markup é"
    assert main_text("<p>1 < 2 and 3 > 2 <3") == "1 < 2 and 3 > 2 <3"
    assert main_text('<p title="a > b">quoted</p><p data-x=\'">\'>again</p>') == "quoted\n\nagain"
    assert main_text("<nav><a href=1>x</a></nav>") == main_text(None) == main_text("") == ""


def test_defined_cases(spark):
    rows = [(1, "u", "<p>one, two.</p>", "x"), (1, "u", "<p>one, two.</p>", "x"), (None, None, None, None), (2, "v", "", ""),
            (3, None, "<p>" + "long text, " * 200_000 + "</p>", "y"), (4, "w", "<script>never closed <p>x", "z")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(map(tuple, extract(df).collect()), key=str)
    assert got == sorted([(1, "u", "one, two.", 9)] * 2 + [(None, None, "", 0), (2, "v", "", 0), (4, "w", "", 0),
                         (3, None, ("long text, " * 200_000).strip(), 2_199_999)], key=str)
    assert extract(df.limit(0)).collect() == [] and extract(df).columns == ["page_id", "url", "text", "n_chars"]


@pytest.mark.parametrize("source", [
    "<div>" * 50_000, "<p>x" * 50_000, "<a <a " * 50_000 + ">", '<a b="' * 50_000, "<" * 200_000, "</x" * 50_000,
    "<td><i>" * 30_000 + "</div>" * 30_000, "<b>" * 30_000 + "<p></b>" * 30_000, "<!--" * 50_000, "<script>" * 30_000,
    "<a " + "x " * 100_000 + ">t", "<h2>Comments</h2><p>x" * 20_000, "<ul><li><a>x</a>" * 20_000, '<a b=">" c=\'' * 30_000])
def test_time_is_linear(source):
    start = time.process_time()
    main_text(source)
    assert time.process_time() - start < 3


TOKENS = st.sampled_from(["<p>", "</p>", "<div class=content>", "</div>", "<article>", "</article>", "<a href='x'>", "</a>",
                          "<b>", "</b>", "<br>", "<ul>", "<li>", "</ul>", "<table>", "<td>", "</table>", "<script>", "</script>",
                          "<!--", "-->", "<h1>", "</h1>", "<", ">", "&amp;", "&#0;", "word, word", " ", "<form>", "</form>", "é"])


@settings(max_examples=300, deadline=None)
@given(st.lists(TOKENS, max_size=40))
def test_any_markup(tokens):
    text = main_text("".join(tokens))
    assert all(b and b == " ".join(b.split()) for b in text.split("\n\n")) or text == ""
