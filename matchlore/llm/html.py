"""Main text of web pages: flat text blocks, classified by a decision tree.

A page is cut into flat blocks: runs of text between tags that start or end a block. A block is
described by its number of words and its link density, by those of the block before and
after it, by the elements around it (an article, a piece of the page's frame inside or around
the innermost article, a name that may mean either, a heading) and by the words that articles elsewhere on the
page hold. A decision tree over these features, trained on the small labelled table below, tells main text
from the rest; it learns for instance that unnamed text beside an article is a notice or a comment, and that a short
text between links belongs to a menu.

Defined results: null and empty pages have no text; broken or cut mark-up is read as far as it goes; an
element that is never closed ends with its parent; repeated rows give equal results.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# HTML element names and words in class, id and role that name parts of a page.
UNREAD = frozenset("script style template noscript head svg math iframe object canvas select textarea datalist title video audio map".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr img".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
FRAME = frozenset("nav footer aside form menu dialog button fieldset header".split())
MAIN = frozenset("article main".split())
FRAME_WORDS = frozenset(
    "nav navbar navigation menu menubar topbar header masthead banner footer sidebar aside widget breadcrumb breadcrumbs crumbs "
    "pagination pager toc ad ads advert adverts advertisement adsbygoogle sponsor sponsored promo promotion commercial "
    "comment comments commentlist respond disqus reply replies cookie cookies consent gdpr notice alert popup "
    "modal overlay newsletter subscribe subscription signup login more-links toolbar skip copyright complementary contentinfo".split()
)
#: Names of a piece of the frame as well as of a page about it: the tree decides by words and links.
HINT_WORDS = frozenset("search share sharing social related recommended recommendations tags discussion reactions feedback legal disclaimer".split())
COMMENT_WORDS = frozenset("comment comments commentlist respond disqus reply replies".split())
MAIN_WORDS = frozenset("article content post entry story main body-text article-body post-body post-content entry-content story-body".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",  # quotes that do not pair
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NOT_SHOWN = re.compile(r"display\s*:\s*none", re.I)
#: Such a class says what a wrapper has or has not, not what it is.
_LAYOUT = re.compile(r"(?:has|no|with|without)[-_]")
_SPACE = re.compile(r"\s+")
#: End tags that may be left out: a start tag here closes an open element of the same group.
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
           "option": {"option"}}
_PARAGRAPH = frozenset(["p"])

#: The labelled table: small pages whose blocks begin with + (main text) or - (the rest). ``~n`` stands for n words.
LABELLED = (
    # an article element inside a page frame
    "<header><a href=/>-~2</a><p>-~6</p></header><nav><ul><li><a href=/>-~1</a><li><a href=/>-~1</a><li><a href=/>-~2</a></ul></nav>"
    "<article><h1>+~8</h1><p>+~60</p><p>+~1</p><p>+~25</p><p>+~2</p><h2>+~3</h2><p>+~90</p><ul><li>+~5</li><li>+~4</li></ul><p>+~9</p></article>"
    "<aside><p>-~30</p><a href=/>-~4</a></aside><footer>-~9</footer>",
    "<div class=ad>-~12</div><article><h1>+~12</h1><p>+~1</p><p>+~2</p><p>+~140</p><p>+~3</p></article><div class=comments><p>-~40</p><p>-~8</p></div><footer><p>-~20</p></footer>",
    "<main><div class=breadcrumb><a href=/>-~3</a></div><h1>+~5</h1><p>+~35</p><p>+~20 <a href=/>~6</a></p><p>+<a href=/>~7</a></p>"
    "<div class=share-bar>-~5</div><p>+~15</p><form><p>-~10</p></form><div class=related><a href=/>-~8</a></div></main><footer>-~45</footer>",
    "<article><header><h1>+~6</h1></header><p>+~30</p><section class=comments><h3>-~2</h3><p>-~55</p><p>-~70</p></section></article><div id=sidebar><p>-~25</p></div>",
    "<div id=cookie-notice><p>-~25</p></div><div class=post><h2>+~7</h2><p>+~45</p><blockquote>+~12</blockquote><p>+~6</p></div><div class=newsletter><p>-~15</p></div>",
    "<article><p>+~4</p><p>+<a href=/>~3</a> ~10</p><aside><p>-~50</p></aside><nav><a href=/>-~2</a></nav><p>+~18</p></article>",
    "<article><h1>+~8</h1><p>+~50</p><p>+~2</p></article>", "<article><p>+~30</p><p>+~1", "<article><h1>+~4</h1><p>+~40</p><p>+~3</p><p>+~1</p>",
    "<main><p>+~12</p><p>+~70</p><p>+~4</p></main>", "<article><h1>+~3</h1></article>", "<nav><a href=/>-~1</a></nav><article><p>+~1</p></article><footer>-~1</footer>",
    "<div class=content-sidebar-wrap><main><h1>+~5</h1><p>+~30</p><p>+~2</p></main><aside><p>-~20</p></aside></div><footer>-~9</footer>",
    # links within and around articles
    "<nav><a href=/>-~2</a></nav><article><p>+~30</p></article>", "<div><a href=/>-~3</a></div><main><p>+~18</p></main><div><a href=/>-~4</a></div>",
    "<article><h1>+<a href=/>~5</a></h1><p>+~2 <a href=/>~1</a></p><ul><li>+<a href=/>~2</a></li><li>+<a href=/>~3</a></li></ul><p>+~3</p><p>+<a href=/>~12</a></p></article>",
    "<nav><a href=/>-~1</a></nav><main><p>+~1</p><p>+<a href=/>~1</a></p><p>+~8</p><p>+<a href=/>~2</a> ~2</p></main><footer><a href=/>-~3</a></footer>",
    "<div><a href=/>-~2</a></div><div class=content><p>+~6</p></div><div><a href=/>-~2</a> <a href=/>~2</a></div>",
    "<article><p>+<a href=/>~20</a></p><p>+~2</p><table><tr><td>+<a href=/>~1</a></td><td>+~2</td></tr><tr><td>+<a href=/>~4</a></td><td>+~1</td></tr></table></article>",
    "<p>-~12</p><p><a href=/>-~5</a></p><article><p>+~35</p></article><p><a href=/>-~6</a></p>",
    # what an article holds is main text at any length, whatever stands around it
    *[
        f"<div><a href=/>-~{k}</a></div><{tag}><p>+~{n}</p><p>+<a href=/>~{k}</a></p><p>+~{n}</p></{tag}><div><a href=/>-~{m}</a></div>"
        for tag in ("article", "main") for n in (1, 3, 8, 20, 40) for k in (1, 5, 12) for m in (1, 12)
    ],
    # articles within forms and oddly named wrappers; comments and teasers that are articles themselves
    "<form id=page><nav><a href=/>-~2</a></nav><article><h1>+~5</h1><p>+~30</p><p>+~1</p></article></form>",
    "<div class=search><article><p>+~40</p><p>+~3</p></article></div><div class=legal><main><p>+~25</p></main></div>",
    "<main><p>+~60</p><p>+~2</p></main><div class=comments><article><p>-~30</p><p>-~3</p></article><article><p>-~70</p></article></div>",
    "<aside><article><h3>-~5</h3><p>-~20</p></article></aside><article><h1>+~5</h1><p>+~50</p></article>",
    "<article><p>+~45</p></article><article class=comment><p>-~40</p><p>-~2</p></article><article class=comment-body>-~15</article>",
    # unnamed notices, comments and teasers beside an article
    "<div>-~13</div><article><h1>+~6</h1><p>+~40</p></article><div>-~2</div><div>-~35</div><div>-~1</div><div>-~90</div>",
    "<p>-~25 <a href=/>~2</a></p><main><p>+~30</p><p>+~80</p></main><p>-~150</p><p>-~60</p><div id=reactions><p>-~45</p></div>",
    "<h1>-~4</h1><div class=post><p>+~120</p></div><h3>-~2</h3><p>-~18</p><p>-~30</p>",
    "<div class=entry>+~3</div><div>+~70</div><div>+~50</div>", "<article><h2>+~4</h2></article><p>+~60</p><p>+~45</p><p>+~80</p>",
    *[
        f"<div>-~{k}</div><{tag}><p>+~{n}</p><p>+~{k}</p></{tag}><div>-~{k}</div><div>-~{m}</div><div>-~{k}</div>"
        for tag in ("article", "main") for n in (20, 60, 120) for k in (2, 14, 30, 70) for m in (5, 30, 100)
    ],
    # the frame of a page, however short its article
    *[
        f"<nav><a href=/>-~{k}</a></nav><div class=ad>-~{m}</div><{tag}><p>+~{n}</p></{tag.split()[0]}><aside><p>-~{m}</p></aside><footer>-~{m}</footer>"
        for tag in ("article", "main", "div class=post") for n in (1, 4, 8, 12, 60) for k in (1, 9) for m in (2, 10, 40, 150)
    ],
    *[
        f"<nav><a href=/>-~{k}</a></nav><h1>+~5</h1><p>+~{n}</p><div class=newsletter>-~{m}</div><p>+~{n}</p><aside><p>-~{m}</p></aside><footer>-~{m}</footer>"
        for n in (16, 40, 90) for k in (1, 9) for m in (2, 10, 40, 150)
    ],
    # a teaser marked as an article above the text itself
    *[
        f"<div class=entry>+~{b}</div><p>+~{n}</p><p>+~{n}</p><aside>-~{m}</aside><footer>-~{m}</footer>"
        for b in (3, 8, 12) for n in (45, 60, 90) for m in (10, 40, 70, 150)
    ],
    # names that say little
    "<div class=search><h1>+~6</h1><p>+~60</p><p>+~45</p></div>", "<div id=legal><p>+~80</p></div>", "<div class=legal>-~12</div>",
    "<div class=search>-~3</div><p>+~50</p><div class=social>-~4 <a href=/>~2</a></div><div class=related><a href=/>-~5</a></div>",
    "<section id=discussion><h2>+~1</h2><p>+~70</p><p>+~30</p></section>",
    "<article><p>+~50</p><section id=discussion><h2>+~1</h2><p>+~60</p></section><div class=tags>-~2</div><div class=related><a href=/>-~9</a> <a href=/>~7</a></div></article>",
    "<article><p>+~30</p><div class=share>-~1</div><div class=related><h3>-~2</h3><a href=/>-~6</a></div></article>",
    # nothing but divisions
    "<div>-~13</div><div><a href=/>-~1</a></div><div><a href=/>-~2</a></div><div>+~40</div><div>+~5</div><div>+~30</div><div>-~3 <a href=/>~4</a></div><div>-~2</div>",
    "<div><a href=/>-~2</a></div><div>-~1</div><div><a href=/>-~3</a></div><div>+~30</div><div>+~4</div><div>+~60</div><div>+~3</div><div>+~25</div><div><a href=/>-~2</a></div>",
    "<div>-~16 <a href=/>~1</a></div><div><a href=/>-~1</a> <a href=/>~1</a></div><p>+~25</p><p>+~2</p><p>+~45</p><div>-~8</div><div><a href=/>-~6</a></div><div>-~11</div>",
    # lists of links with a heading or a teaser each; the same lengths within prose
    "<div>-~3</div><div><a href=/>-~9</a></div><div><a href=/>-~11</a></div><div>+~3</div><div>+~50</div><div>+~3</div><div>+~40</div><div>-~3</div><div><a href=/>-~8</a></div><div><a href=/>-~10</a></div>",
    "<div><a href=/>-~8</a></div><div>-~22</div><div><a href=/>-~7</a></div><div>-~24</div><div><a href=/>-~9</a></div><div>-~20</div><div><a href=/>-~7</a></div>",
    "<div>+~45</div><div>+~22</div><div>+~9</div><div>+~24</div><div>+~11</div><div>+~38</div><div>-~2</div><div><a href=/>-~12</a></div><div>-~19</div><div><a href=/>-~14</a></div>",
    "<h3>-~4</h3><div><a href=/>-~12</a></div><h3>-~2</h3><div><a href=/>-~15</a></div><h2>+~4</h2><div>+~60</div><h2>+~2</h2><div>+~12</div><div>+~33</div>",
    "<div><a href=/>-~6</a></div><div>-~10</div><div><a href=/>-~6</a></div><div>+~28</div><div>+~10</div><div>+~31</div><div><a href=/>-~6</a></div><div>-~10</div><div><a href=/>-~9</a></div>",
    "<article><h2>+~4</h2><p>+~8</p></article><p>+~60</p><p>+~35</p><p>+~50</p>",
    "<p>+~30</p><p>+~26</p><p>-~4 <a href=/>~12</a></p><p>-~2 <a href=/>~9</a></p>", "<p>+~40 <a href=/>~10</a></p><p>+~8 <a href=/>~3</a></p><p>+~35</p>",
    "<div><a href=/>-~1</a></div><div><a href=/>-~2</a></div><div><a href=/>-~1</a></div><div><h1>+~7</h1></div><div>+~50</div><div>+~35</div><div>+~8</div><div>+~60</div><div><a href=/>-~3</a></div><div>-~4</div>",
    "<div><a href=/>-~2</a> <a href=/>~2</a> <a href=/>~1</a></div><p>+~40</p><p>+~28</p><p>+~16</p><p>+~30 <a href=/>~4</a></p><div><a href=/>-~4</a></div><div><a href=/>-~5</a></div>",
    "<table><tr><td><a href=/>-~3</a></td><td>+~80</td></tr><tr><td><a href=/>-~2</a></td><td>+~55</td></tr></table><p>-~3</p>",
    "<h1>+~6</h1><p>+~22</p><p>+~18</p><p>+~33</p><p>+~12</p><p>+~27</p><div class=footer>-~14</div><div class=advert>-~18</div>",
    "<p>+~20</p><p>+~70</p><p>+~11</p><p>+~30</p>", "<p>+~15</p>", "<div>+~120</div>",
    "<div class=menu><p>-~12</p></div><div class=header><h1>-~4</h1></div><div class=content><p>+~2</p><p>+~80</p><p>+~5</p></div><div role=contentinfo><p>-~60</p></div>",
)

FEATURES = (
    "words", "links", "words_before", "links_before", "words_after", "links_after",
    "frame", "main", "heading", "around", "hint", "beside",
)


@dataclass(frozen=True)
class Place:
    """What the open elements say, from the outermost to one of them."""

    tag: str = ""
    hidden: bool = False
    main: int = 0
    #: 2 for a piece of the frame inside the innermost article, 1 if that is a form or only a part of a name says so
    frame: int = 0
    #: a piece of the frame around the innermost article
    around: int = 0
    hint: int = 0
    heading: int = 0
    anchors: int = 0

    def inside(self, tag: str, kind: str) -> Place:
        main, frame, around, hint = self.main, self.frame, self.around, self.hint
        if kind == "main":
            # wrappers and forms around an article are no frame of it
            main, frame, around, hint = 1, 0, int(around or frame == 2), 0
        elif kind == "frame" and not (tag == "header" and main):  # the header of an article is not the header of the page
            frame = max(frame, 1 if tag == "form" else 2)
        elif kind == "wrap":
            frame = max(frame, 1)
        elif kind == "hint":
            hint = 1
        return Place(tag, self.hidden or kind == "hidden", main, frame, around, hint, int(self.heading or tag in HEADINGS), self.anchors + (tag == "a"))


@dataclass
class Block:
    place: Place
    parts: list[str] = field(default_factory=list)
    linked: list[str] = field(default_factory=list)
    text: str = ""
    words: int = 0
    links: float = 0.0


def _attributes(raw: str) -> dict[str, str]:
    """Values by lower-cased name; the first of a name counts."""
    out: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(raw):
        out.setdefault(name.lower(), "".join(values))
    return out


def _hidden(raw: str) -> bool:
    if not raw:
        return False
    named = _attributes(raw)
    return "hidden" in named or named.get("aria-hidden", "").lower() == "true" or bool(_NOT_SHOWN.search(named.get("style", "")))


def _kind(tag: str, attributes: str) -> str:
    """What an element is to the page: main, frame, hint or nothing of its own; wrap if only a part of a name says frame."""
    if tag in FRAME:
        return "frame"
    names: set[str] = set()
    if attributes and tag not in INLINE and tag not in ("body", "html"):
        named = _attributes(attributes)
        names = {w for n in ("class", "id", "role") for w in named.get(n, "").lower().split()}
    if names & MAIN_WORDS:
        return "main"
    parts = {p for w in names if not _LAYOUT.match(w) for p in re.split(r"[-_]", w)}
    if names & FRAME_WORDS or (tag in MAIN and parts & COMMENT_WORDS):
        return "frame"
    if tag in MAIN:
        return "main"
    if parts & FRAME_WORDS:
        return "wrap"
    return "hint" if parts & HINT_WORDS else ""


def blocks(page: str) -> list[Block]:
    """The flat text blocks of a page that hold any text; time grows with the page, however deep its elements."""
    out: list[Block] = []
    outside = Place()
    stack: list[Place] = []
    opened: Counter[str] = Counter()
    block: Block | None = None

    def end() -> None:
        nonlocal block
        if block is not None:
            block.text = _SPACE.sub(" ", "".join(block.parts)).strip()
            block.words = len(block.text.split())
            linked = len(_SPACE.sub(" ", " ".join(block.linked)).split())
            block.links = min(1.0, linked / block.words) if block.words else 0.0
            if block.text:
                out.append(block)
        block = None

    def text(raw: str) -> None:
        nonlocal block
        place = stack[-1] if stack else outside
        if not raw or place.hidden:
            return
        if block is None:
            block = Block(place)
        block.parts.append(raw)
        if place.anchors:
            block.linked.append(raw)

    def leave() -> str:
        tag = stack.pop().tag
        opened[tag] -= 1
        return tag

    at, size = 0, len(page)
    while at < size:
        token = _TOKEN.search(page, at)
        text(unescape(page[at : token.start() if token else size]))
        if not token:
            break
        at = token.end()
        closing, tag, attributes = token.group(1, 2, 3) if token.group(2) else token.group(4, 5, 6)
        tag, attributes = (tag or "").lower(), attributes or ""
        if not tag:
            continue
        if not closing and tag in UNREAD and not attributes.endswith("/"):
            at = _after(page, at, tag)
            if tag not in INLINE:
                end()
            continue
        if tag not in INLINE:
            end()
        if closing:
            if opened[tag]:
                while leave() != tag:
                    pass
        elif tag not in VOID:
            if tag not in INLINE:
                # formatting and paragraphs that were left open end here
                while stack and stack[-1].tag in INLINE and not stack[-1].hidden:
                    leave()
                while stack and stack[-1].tag in _CLOSES.get(tag, _PARAGRAPH):
                    leave()
            hidden = _hidden(attributes) and not attributes.endswith("/")
            stack.append((stack[-1] if stack else outside).inside(tag, "hidden" if hidden else _kind(tag, attributes)))
            opened[tag] += 1
    end()
    return out


def _after(page: str, at: int, tag: str) -> int:
    """Behind the end tag of an element whose content is not read (nested elements of its name counted)."""
    if tag in ("head",):
        found = re.compile(r"</head\s*>|(?=<body\b)", re.I).search(page, at)
        return found.end() if found else at
    depth = 1
    for found in re.compile(rf"<(/?){re.escape(tag)}\b[^>]*>", re.I).finditer(page, at):
        depth += -1 if found.group(1) else (0 if tag in ("script", "style", "textarea", "title") else 1)
        if not depth:
            return found.end()
    return len(page)


def features(found: list[Block]) -> list[tuple[float, ...]]:
    rows = []
    held = sum(b.words for b in found if b.place.main and not b.place.frame and not b.place.around)
    for i, b in enumerate(found):
        before, after = found[i - 1] if i else None, found[i + 1] if i + 1 < len(found) else None
        place = b.place
        rows.append((
            float(b.words), b.links, float(before.words if before else 0), before.links if before else 0.0,
            float(after.words if after else 0), after.links if after else 0.0,
            float(place.frame > 0), float(place.main), float(place.heading), float(place.around), float(place.hint),
            float(0 if place.main or place.frame else held),
        ))
    return rows


def labelled(pages: tuple[str, ...] = LABELLED) -> list[tuple[float, tuple[float, ...]]]:
    """The labelled table as rows of label and features."""
    rows = []
    for page in pages:
        found = blocks(re.sub(r"~(\d+)", lambda m: " ".join(["word"] * int(m.group(1))), page))
        rows += zip([float(b.text.startswith("+")) for b in found], features(found))
    return rows


Node = tuple[int, float, "Node", "Node"] | float


def trained(spark: SparkSession, pages: tuple[str, ...] = LABELLED, depth: int = 12) -> Node:
    """A decision tree over ``FEATURES``: nodes (feature, threshold, at most, above), leaves the label."""
    table = spark.createDataFrame([(label, Vectors.dense(row)) for label, row in labelled(pages)], ["label", "features"])
    model = DecisionTreeClassifier(maxDepth=depth, maxBins=64, seed=42).fit(table.coalesce(1))

    def read(node) -> Node:  # noqa: ANN001  a node of the fitted model
        if node.subtreeDepth() == 0:
            return node.prediction()
        split = node.split()
        return split.featureIndex(), split.threshold(), read(node.leftChild()), read(node.rightChild())

    return read(model._call_java("rootNode"))


def is_main(tree: Node, row: tuple[float, ...]) -> bool:
    while isinstance(tree, tuple):
        feature, threshold, low, high = tree
        tree = low if row[feature] <= threshold else high
    return tree > 0.5


def main_text(page: str | None, tree: Node) -> str:
    found = blocks(page or "")
    return " ".join(b.text for b, row in zip(found, features(found)) if is_main(tree, row))


def main_texts(spark: SparkSession, page: str = "html") -> Column:
    tree = trained(spark)

    def of(pages: pa.Array) -> pa.Array:
        return pa.array([main_text(p.as_py(), tree) for p in pages], pa.string())

    return F.arrow_udf(of, "string")(page)


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    found = pages.select("page_id", "url", main_texts(pages.sparkSession).alias("text"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
