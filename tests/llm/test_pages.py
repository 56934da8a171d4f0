"""Operator 13."""

import html
import re

import pytest

from plumbline.llm import main_text
from plumbline.llm.main_text import main_lines

P = ["The first paragraph of the article tells at some length what happened in the town on that day.", "A short one.",
     "The third paragraph goes on, with <a href='/x'>a link</a> and some <em>emphasis</em> to make it less plain."]
BODY = "".join(f"<p>{p}</p>" for p in P)
TEXT = [re.sub("<[^>]*>", "", p) for p in P]
LINKS = "<ul><li><a href=1>One</a><li><a href=2>Two</a></ul>"

PAGES = {
    "divs only": (
        f"<html><body><div id=header><a href=/>Home</a></div><div id=menu>{LINKS}</div><div id=wrap><div id=content>"
        f"<h1>Title</h1><div class=body>{BODY}</div></div><div id=sidebar><p>Some text about the author, who lives in a "
        "house and writes long texts.</p></div></div><div id=footer>&copy; 2020 All rights reserved by them.</div>",
        ["Title", *TEXT]),
    "main, article, comments": (
        f"<body class='has-sidebar'><header><h1>Site</h1><nav>{LINKS}</nav></header><main><article class=post><header>"
        f"<h1>Title</h1></header>{BODY}<div class=ad>Buy now</div><p>Last words.</p><section class=comments><h2>Comments"
        "</h2><article class=comment><p>Great text, thanks a lot for writing such a long and deep thing about this.</p>"
        "</article></section></article><aside>Related</aside></main><div class='cookie-notice'>We use cookies.</div>",
        ["Title", *TEXT, "Last words."]),
    "one form around everything": (
        f"<body><form id=f><div class=topbar><a href=/>Home</a></div><div><h2>Title</h2>{BODY}</div><input></form>",
        ["Title", *TEXT]),
    "form in an article": (f"<article>{BODY}<form><label>Name</label><p>Sign up</p></form><p>End</p></article>",
                           [*TEXT, "End"]),
    "menu never closed": (f"<body><nav>{LINKS}<article><h1>Title</h1>{BODY}</article>", ["Title", *TEXT]),
    "table": (f"<table><tr><td>{LINKS}<td><h1>Title</h1>{BODY}<td class=ads>Buy now</table>", ["Title", *TEXT]),
    "lists": (f"<article>{BODY}<ul><li>Point one<li>Point <b>two</b></ul>{LINKS}<pre>a  b\n c</pre></article>",
              [*TEXT, "Point one", "Point two", "a b c"]),
    "comments by their heading": (
        f"<div><h1>Title</h1>{BODY}<div><h3>3 Comments</h3><p>Nice one this was, I really liked it.</p></div></div>",
        ["Title", *TEXT]),
    "scripts": (f"<article>{BODY}<script>if (a<b) {{ w('<p>x</p>') }}</script><style>p{{}}</style><p>End</article>",
                [*TEXT, "End"]),
    "hidden": (f"<article>{BODY}<p hidden>no</p><div style='display: none'>no</div><p>End</p></article>", [*TEXT, "End"]),
    "references": (f"<article>{BODY}<p>a&nbsp;&nbsp;b &#x41;&#66; &eacute; &am &lt;tag&gt; &amp</p></article>",
                   [*TEXT, "a b AB é &am <tag> &"]),
    "declarations": (f"<![foo[ x ]]><!DOCTYPE html><?php echo ?><article>{BODY}<!-- <p>no</p> --><!--[if IE]><p>no</p>"
                     "<![endif]--><p>End</article><!-- never ended <p>no</p>", [*TEXT, "End"]),
    "teasers": (f"<main><article><h1>Title</h1>{BODY}</article><section><article class=card><h3><a href=1>Other</a></h3>"
                "<p>A teaser of the other story.</p></article></section></main>", ["Title", *TEXT]),
    "stray ends": (f"<div><article></div></p></b>{BODY}</section></article></div><footer>f</footer>", TEXT),
    "plain": ("no markup, a < b &amp; c > d", ["no markup, a < b & c > d"]),
    "breaks": ("<div>one<br>two<br><br>three</div>", ["one two three"]),
    "upper case": (f"<BODY><DIV CLASS='Main-Content'><H1>Title</H1>{BODY}</DIV><DIV CLASS=SideBar><P>x</P></DIV></BODY>",
                   ["Title", *TEXT]),
    "nothing": ("<nav><a href=1>x</a></nav><script>x</script>", []),
}


@pytest.mark.parametrize("name", PAGES)
def test_layouts(name):
    page, want = PAGES[name]
    assert main_lines(page) == want


@pytest.mark.parametrize("page", [
    "<" * 200_000, "<a " * 100_000, "<a " * 50_000 + ">", "<!--" * 100_000, "<!--" * 100_000 + ">", "&" * 300_000,
    "<div>" * 30_000, "<div>x" * 30_000, "<p>" * 50_000, "<b><p>x" * 20_000, "<![x" * 50_000 + ">", "</" * 100_000,
    "<ul><li>x" * 20_000, "</div>" * 50_000, '<a href="' * 50_000 + ">", "",
])
def test_broken_pages_are_read_in_time(page):
    main_lines(page)


def test_text_without_markup_is_whole():
    page = "word " * 400_000
    assert main_text.main_text(page) == page.strip()


def plainly(page):
    """What the given pages' template holds between its article tags."""
    article = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
    parts = [re.sub("<[^>]*>", "", p.replace("<br>", " ")) for p in re.split(r"</?(?:p|h1)>", article)]
    return "\n\n".join(t for t in (" ".join(html.unescape(p).split()) for p in parts) if t)


def test_op13_equals_a_plain_reading(shared, folder):
    pages = {r["page_id"]: r for r in shared.read.parquet(f"{folder}/pages.parquet").collect()}
    got = main_text.op13_tag_ratio(shared, folder).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r["text"] == plainly(pages[r["page_id"]]["html"]) and r["n_chars"] == len(r["text"])
        assert r["url"] == pages[r["page_id"]]["url"]


def test_odd_rows(shared):
    rows = [(1, None, 1, "t"), (None, "", 2, None), (2, f"<article>{BODY}</article>", 3, "t")] * 2
    pages = shared.createDataFrame(rows, "page_id bigint, html string, `a.b` int, text string").selectExpr(
        "*", "5 AS _kept", "6 AS _page")
    got = main_text.extract(pages)
    assert got.columns == ["page_id", "a.b", "_kept", "_page", "text", "n_chars"]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(
        repr((i, n, 5, 6, t, len(t))) for i, page, n, _ in rows for t in ["\n\n".join(TEXT) if page else ""])
    assert main_text.extract(pages.where("false")).count() == 0
    assert main_text.extract(pages.select("html")).columns == ["text", "n_chars"]
