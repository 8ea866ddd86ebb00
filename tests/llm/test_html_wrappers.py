"""Texts in wrappers with frame words, beside hidden elements, unnamed notices and comments; given pages against a plain parser."""

import re
from html.parser import HTMLParser

import pytest

from matchlore.llm import html

LONG = " ".join(["word"] * 40)
PAGES = [
    (f'<div class="content-sidebar-wrap"><main><p>{LONG}</p></main><aside>{LONG}</aside></div>', LONG),
    (f'<div class="site has-sidebar"><article><p>{LONG}</p></article></div>', LONG),
    (f'<div class="no-sidebar"><p>{LONG}</p><p>{LONG}</p></div>', f"{LONG} {LONG}"),
    (f'<article><p>{LONG} <a title="The hidden city" href=/>x</a> y</p></article>', LONG + " x y"),
    (f'<article><div class="flex hidden md:block"><p>{LONG}</p></div></article>', LONG),
    (f'<article><div title="a class=comments id=ad b"><p>{LONG}</p></div></article>', LONG),
    (f"<article><p hidden>no<p>{LONG}</article>", LONG),
    (f'<article><ul><li style="display:none">no<li>{LONG}</ul><p>{LONG}</p></article>', f"{LONG} {LONG}"),
    (f"<article><table><tr hidden><td>no<td>no<tr><td>{LONG}</table></article>", LONG),
    (f'<nav><a href=/>Home</a></nav><div class="search"><article><h1>A b</h1><p>{LONG}</p><p>c</p></article></div>', f"A b {LONG} c"),
    (f'<div id="legal"><p>{LONG} {LONG}</p></div>', f"{LONG} {LONG}"),
    (f"<div class=search>Find it</div><h1>Title here</h1><p>{LONG}</p>", f"Title here {LONG}"),
    (f"<form id=page><div><a href=/>Home</a></div><article><p>{LONG}</p></article></form>", LONG),
    (f"<div>We use little files on your machine to know you again later on</div><article><p>{LONG}</p><p>{LONG}</p></article>", f"{LONG} {LONG}"),
    (f"<article><p>{LONG}</p></article><div id=reactions><p>Bob</p><p>{LONG}</p></div><div><div>Eve</div><div>{LONG} no</div></div>", LONG),
    (f"<article><p>{LONG}</p></article><section class=comments><article><p>{LONG} no</p></article></section><article class=comment>{LONG}</article>", LONG),
    (f"<article>One two</article><footer>{LONG}</footer>", "One two"),
    (f"<article>One two</article><p>{LONG}</p><p>{LONG}</p>", f"One two {LONG} {LONG}"),
    (f"<h1>Title here</h1><p>{LONG}</p><footer>{LONG} {LONG}</footer>", f"Title here {LONG}"),
    ("<div>" * 50_000 + f"<p>{LONG}</p>", LONG),
    (f"<article><div aria-hidden=true>no<div>no</div>no</div><p>{LONG} <span hidden>no</span>z</p></article>", LONG + " z"),
]


@pytest.fixture(scope="module")
def tree(spark):
    return html.trained(spark)


@pytest.mark.parametrize(("page", "text"), PAGES)
def test_texts(tree, page, text):
    assert html.main_text(page, tree) == text


class Plain(HTMLParser):
    """The text of article elements by the library's parser, a space at every tag that is not bold."""

    def __init__(self):
        super().__init__()
        self.inside, self.parts = False, []

    def handle_starttag(self, tag, attrs):
        self.inside |= tag == "article"
        self.parts += [" "] * (tag != "b")

    def handle_endtag(self, tag):
        self.inside &= tag != "article"
        self.parts += [" "] * (tag != "b")

    def handle_data(self, data):
        self.parts += [data] * self.inside


def test_given_pages_against_a_plain_parser(spark, data):
    rows = spark.read.parquet(f"{data}/pages.parquet")
    got = {r["page_id"]: r["text"] for r in html.extracted(rows).collect()}
    for r in rows.select("page_id", "html").collect():
        plain = Plain()
        plain.feed(r["html"] or "")
        plain.close()
        assert got[r["page_id"]] == re.sub(r"\s+", " ", "".join(plain.parts)).strip()


def test_the_tree_weighs_words_and_links_of_neighbours(tree):
    def used(node):
        return {html.FEATURES[node[0]]} | used(node[2]) | used(node[3]) if isinstance(node, tuple) else set()

    assert {"words", "links", "words_after", "links_after", "frame", "main", "hint", "around", "beside"} <= used(tree)
    menu = "<div>-~14</div><div><a href=/>-~9</a></div>"
    prose = "<div>+~14</div><div>+~30</div>"
    for page in (menu, prose):
        (label, row), *_ = html.labelled((page,))
        assert html.is_main(tree, row) == (label > 0.5)
