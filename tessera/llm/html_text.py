"""Main text of web pages: flat text blocks, judged by a decision tree.

A page is cut into blocks at block-level tags, by one scan from its first to its last
character. A block's measures are its words and link density, those of its neighbours, and
where it stands: in an article, in an element that is page furniture by its tag, or by the
words of its class, id or role, in a paragraph, in a heading. A small decision tree, grown
here on the labelled pages below, tells main text from the rest.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, slices

# Tag names as HTML defines them.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p"
    " pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements without an end tag.
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup.
RAW_TAGS = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: Elements that show no text of the page: controls, drawings, and what stands in for scripts and media.
SILENT_TAGS = frozenset(
    "audio button canvas datalist label noscript object optgroup option select svg template video".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Page furniture by tag.
FURNITURE_TAGS = frozenset("nav footer aside form menu dialog search fieldset".split())
#: Measured as page furniture by a word of class, id or role.
FURNITURE_WORDS = frozenset(
    "ad ads advert advertisement adverts alert banner breadcrumb breadcrumbs cc comment comments consent contentinfo"
    " cookie cookies copyright disclaimer disqus feedback footer gdpr header login masthead menu menubar modal nav navbar"
    " navigation newsletter notice pagination paywall popup promo promoted promotion related replies reply respond search"
    " share sharing sidebar signup skip social sponsor sponsored subscribe teaser toolbar widget".split()
)
#: Those of them that stand for what readers wrote.
REMARKS = frozenset("comment comments disqus feedback replies reply respond".split())

#: Start tags that end an open element of some kind (any in the first set), unless one of the second stands between.
_ENDS = {
    **dict.fromkeys(("li",), (("li",), ("ul", "ol", "menu", "dir"))),
    **dict.fromkeys(("dt", "dd"), (("dt", "dd"), ("dl",))),
    **dict.fromkeys(("td", "th"), (("td", "th"), ("table",))),
    **dict.fromkeys(("tr",), (("tr",), ("table",))),
    **dict.fromkeys(("thead", "tbody", "tfoot", "caption"), (("thead", "tbody", "tfoot", "caption"), ("table",))),
    **dict.fromkeys(("option", "optgroup"), (("option",), ("select",))),
    **dict.fromkeys(("button",), (("button",), ())),
}
_CELLS = ("td", "th", "caption")
_TABLE = frozenset("table thead tbody tfoot tr td th caption".split())
#: A tag whose attributes hold no < and whose quotes, if any, are closed.
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/><]*+)((?:[^<>=]++|=\s*+(?:\"[^\"<]*+\"|'[^'<]*+'|(?![\"'])))*+)>")
_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
_STEP = re.compile(r"=\s*([\"'])|>")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in RAW_TAGS}
_NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

MEASURES = (
    "words", "links", "words_before", "links_before", "words_after", "links_after",
    "furniture", "named", "article", "heading", "prose",
)


@dataclass
class Block:
    text: str
    links: float
    furniture: bool
    named: bool
    article: bool
    heading: bool
    prose: bool


@lru_cache(maxsize=1 << 14)
def _names(attributes: str) -> frozenset[str]:
    """The furniture words among those of class, id and role."""
    found = {w.lower() for m in _NAMED.finditer(attributes) for w in _WORDS.findall(m[1] or m[2] or m[3] or "")}
    return frozenset(found & FURNITURE_WORDS)


class _Page:
    """One scan of a page. Elements are numbered in order; lists hold what is known of each; 0 is the page itself."""

    def __init__(self, page: str):
        self.page = page
        self.tag, self.parent, self.names = [""], [-1], [frozenset()]
        self.silent, self.heading, self.article = [False], [False], [0]  # article: the nearest such element, 0 for none
        self.open = [0]
        self.where: dict[str, list[int]] = defaultdict(lambda: [-1])  # depths of open elements by tag, after a -1
        self.depths: list[int] = []  # depths of open block-level elements
        self.parts: list[str] = []
        self.linked: list[str] = []
        self.anchor = False
        self.found: list[tuple[str, float, int]] = []  # text, links, element
        self.holds_h1: set[int] = set()
        self.first_h1 = 0
        self.scan()
        self.close()

    def depth(self, tags: tuple[str, ...]) -> int:
        """Of the innermost open element of these tags; -1 without any."""
        out = -1
        for t in tags:
            if self.where[t][-1] > out:
                out = self.where[t][-1]
        return out

    def pop_to(self, depth: int) -> None:
        """Ends open elements from the innermost to the one at this depth."""
        while len(self.open) > depth:
            tag = self.tag[self.open.pop()]
            self.where[tag].pop()
            if tag in BLOCK_TAGS:
                self.depths.pop()

    def close(self) -> None:
        """Ends a block."""
        if not self.parts:
            return
        text = " ".join(html.unescape("".join(self.parts)).split())
        if text:
            inner = len(" ".join(html.unescape("".join(self.linked)).split())) if self.linked else 0
            self.found.append((text, min(1.0, inner / len(text)), self.at))
        self.parts, self.linked = [], []

    def add(self, text: str) -> None:
        here = self.open[-1]
        if text and not self.silent[here]:
            if not self.parts:
                if text.isspace():
                    return
                self.at = here
            self.parts.append(text)
            if self.anchor:
                self.linked.append(text)

    def tag_end(self, at: int) -> int:
        """Where a tag ends whose quotes hold < or don't close; -1 if never."""
        while m := _STEP.search(self.page, at):
            if not m[1]:
                return m.end()
            at = m.end()
            if m[1] in self.unclosed:
                continue
            close = self.page.find(m[1], at)
            if close < 0:
                self.unclosed.add(m[1])  # nor is there one for any later tag
            else:
                at = close + 1
        return -1

    def scan(self) -> None:
        page, at = self.page, 0
        self.unclosed: set[str] = set()
        endless: set[str] = set()
        while (lt := page.find("<", at)) >= 0:
            if lt > at:
                self.add(page[at:lt])
            m = _TAG.match(page, lt)
            if m:
                ends, tag, attributes, at = m[1], m[2].lower(), m[3], m.end()
            elif page.startswith("<!--", lt):
                end = page.find("-->", lt + 2)  # <!--> is whole
                if end < 0:
                    return
                at = end + 3
                continue
            elif name := _NAME.match(page, lt):
                end = self.tag_end(name.end())
                if end < 0:
                    return
                ends, tag, attributes, at = name[1], name[2].lower(), page[name.end() : end - 1], end
            elif page[lt + 1 : lt + 2] in ("!", "?", "/"):
                end = page.find(">", lt)
                if end < 0:
                    return
                at = end + 1
                continue
            else:
                self.add("<")
                at = lt + 1
                continue
            if ends:
                self.end(tag)
                continue
            self.start(tag, attributes)
            if tag in RAW_TAGS and tag not in endless:
                stop = _RAW_END[tag].search(page, at)
                if stop:
                    at = stop.start()
                elif tag in ("script", "style"):
                    return
                else:
                    endless.add(tag)
        self.add(page[at:])

    def start(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self.add(" ")
            return
        if tag in ("html", "body", "head"):
            self.close()
            return
        block = tag in BLOCK_TAGS
        if block:
            self.close()
            p = self.where["p"][-1]
            if p >= 0 and p > self.depth(_CELLS):
                self.pop_to(p)
            if tag in HEADINGS and self.tag[self.open[-1]] in HEADINGS:
                self.pop_to(len(self.open) - 1)
        if tag in _ENDS:
            mine, between = _ENDS[tag]
            if self.depth(mine) > self.depth(between):
                self.pop_to(self.depth(mine))
        if tag == "a":
            self.anchor = True
        if tag in VOID_TAGS or tag in RAW_TAGS:
            return
        names = _names(attributes) if attributes else frozenset()
        here = self.open[-1]
        if names and not block:
            self.close()
        if not block and not names and not attributes and tag not in SILENT_TAGS:
            kind = here  # plain inline elements say nothing about their text
        else:
            kind = len(self.tag)
            self.parent.append(here)
            self.tag.append(tag)
            self.names.append(names)
            self.silent.append(self.silent[here] or tag in SILENT_TAGS or bool(attributes and _HIDDEN.search(attributes)))
            self.heading.append(self.heading[here] or tag in HEADINGS)
            self.article.append(kind if tag in ("article", "main") else self.article[here])
            self.where[tag].append(len(self.open))
            if block:
                self.depths.append(len(self.open))
            self.open.append(kind)
        if tag == "h1" and self.depth(("header", "nav", "aside", "footer")) < 0:
            self.holds_h1.add(self.article[kind])
            self.first_h1 = self.first_h1 or kind

    def end(self, tag: str) -> None:
        block = tag in BLOCK_TAGS
        if block:
            self.close()
        if tag == "a":
            self.anchor = False
        depth = self.where[tag][-1]
        if depth < 0:
            return
        if block or tag in SILENT_TAGS:
            if tag in _TABLE or depth > self.depth(_CELLS):
                if tag not in _ENDS or depth > self.depth(_ENDS[tag][1]):
                    self.pop_to(depth)
        elif not self.depths or depth > self.depths[-1]:
            if self.names[self.open[depth]]:
                self.close()
            self.pop_to(depth)

    def blocks(self) -> list[Block]:
        n = len(self.tag)
        words = [0] * n
        total = 0
        for text, _, at in self.found:
            size = text.count(" ") + 1
            words[at] += size
            total += size
        inner = words[:]
        for k in range(n - 1, 0, -1):  # children come after parents
            inner[self.parent[k]] += inner[k]
        furniture = [t in FURNITURE_TAGS for t in self.tag]
        named = [bool(s) for s in self.names]
        for k in range(1, n):
            in_article = bool(self.article[self.parent[k]])
            if self.tag[k] == "header" and not in_article:
                furniture[k] = True
            if in_article and self.names[k] == {"header"}:
                named[k] = False
        self.exempt(furniture, named, inner, total)
        for k in range(1, n):
            up = self.parent[k]
            furniture[k], named[k] = furniture[k] or furniture[up], named[k] or named[up]
        prose = [False] * n
        for k in range(1, n):
            tag = self.tag[k]
            prose[k] = tag in ("p", "blockquote", "pre") or tag not in BLOCK_TAGS and prose[self.parent[k]]
        return [
            Block(text, links, furniture[at], named[at], bool(self.article[at]), self.heading[at], prose[at])
            for text, links, at in self.found
        ]

    def exempt(self, furniture: list[bool], named: list[bool], inner: list[int], total: int) -> None:
        """What holds the page's main part isn't furniture, whatever it is called."""
        outer = [False] * len(self.tag)
        for k in range(1, len(outer)):
            outer[k] = named[k] or furniture[k] or outer[self.parent[k]]
        parts = [k for k, t in enumerate(self.tag) if t in ("article", "main")]
        best = max(parts, key=lambda k: (k in self.holds_h1, not outer[k], inner[k]), default=0)
        if best and not (best in self.holds_h1 or 2 * inner[best] >= total):
            best = 0
        top = best or (self.first_h1 if not parts else 0)
        k = top
        while k > 0:
            furniture[k] = named[k] = False
            k = self.parent[k]
        # nor is what holds most of that, or of a page without such a part
        whole = inner[best] if best else total if not top else 0
        for k in range(1, len(outer)):
            if whole and named[k] and 5 * inner[k] >= 3 * whole and not self.names[k] & REMARKS:
                up = k
                while up > 0 and up != best:
                    up = self.parent[up]
                if up == best:
                    named[k] = False


def blocks(page: str) -> list[Block]:
    """The text blocks of a page in order. White space in a block is one space; references are decoded."""
    return _Page(page).blocks()


def measure(found: list[Block]) -> np.ndarray:
    """A row of MEASURES for each block; beyond the first and last block there are no words and no links."""
    words = np.array([0, *(b.text.count(" ") + 1 for b in found), 0], float)
    links = np.array([0, *(b.links for b in found), 0], float)
    flags = np.array([(b.furniture, b.named, b.article, b.heading, b.prose) for b in found], float).reshape(-1, 5)
    sides = [words[1:-1], links[1:-1], words[:-2], links[:-2], words[2:], links[2:]]
    return np.column_stack([*sides, flags])


# Labelled pages, written and labelled by hand. +n stands for n words of main text, -n for n words of anything else.
PAGES = (
    # news: menu, advert, article, related links, footer
    "<header><a href=/>-2</a></header><nav><ul><li><a href=/>-1</a><li><a href=/>-2</a><li><a href=/>-1</a></ul></nav><div class=ad>-8</div>"
    "<article><h1>+9</h1><p>+60<p>+1<p>+85<p>+3<p>+40</article><aside><h2>-2</h2><p>-25<a href=/>-6</a></aside><footer>-12</footer>",
    "<nav><a href=/>-4</a></nav><article><header><h1>+12</h1><p>+6</p></header><p>+1<p>+2<p>+1<p>+150<h2>+3</h2><p>+2</article>"
    "<div class=related-articles><a href=/>-9</a><a href=/>-8</a></div><footer><p>-30</p></footer>",
    "<div id=top-banner>-14</div><main><h1>+1</h1><p>+5<ul><li>+4<li>+9<li>+2</ul><p>+33<table><tr><td>+1<td>+2<tr><td>+1<td>+3</table></main>"
    "<div class=footer><p>-9<p>-45</div>",
    # an article with furniture of its own
    "<article><h1>+6</h1><div class=share><a href=/>-1</a> <a href=/>-1</a></div><p>+70<div class=newsletter-signup><p>-18</p></div><p>+2"
    "<figure><figcaption>+9</figcaption></figure><aside>-35</aside><p>+44<blockquote>+12</blockquote><form>-3</form><div class=promo>-1</div>"
    "<p><a href=/>+1</a><p>+25<section class=comments><h3>-2</h3><p>-40<p>-3<p>-75</section></article>",
    "<main><div class=breadcrumbs><a href=/>-1</a><a href=/>-1</a></div><article><h1>+8</h1><p>+2<p><a href=/>+3</a> +1<p>+1<pre>+14</pre>"
    "<nav><a href=/>-2</a></nav><p>+90<div class=advert>-50</div><p>+7</article><div id=comments><article><p>-30</article><article><p>-2</article></div></main>",
    "<article class=post><h1>+5</h1><p>+22<p>+18<div class=sponsored><p>-60</p></div><p>+1<dl><dt>+1<dd>+6</dl><p>+3</article><div class=social><a href=/>-1</a></div>",
    # blogs and forums without an article element
    "<div class=masthead><p>-3</div><ul class=menu><li><a href=/>-1</a><li><a href=/>-1</a></ul><div id=content><h1>+7</h1><p>+55<p>+4<p>+80"
    "<p>+2<p>+31</div><div id=sidebar><h2>-2</h2><p>-20<ul><li><a href=/>-5</a></ul></div><ol class=comment-list><li><p>-12<li><p>-66</ol><div class=copyright>-6</div>",
    "<div><a href=/>-1</a> <a href=/>-1</a></div><h1>+4</h1><div>+65</div><div>+5</div><h2>+3</h2><div>+90</div><div><a href=/>-2</a></div><div class=footer>-1</div>",
    "<h1>+10</h1><p>+4<p>+6<p>+3<p>+5<p>+1<p>+4<div class=footer>-8</div>",
    "<table><tr><td><a href=/>-1</a><td><a href=/>-2</a></table><h2>+6</h2><p>+3<p>+8<p>+2<p>+5<h3>+2</h3><p>+7<div class=disclaimer><p>-25</div>",
    "<p>+2<p>+6<p>+4<p>+9<p>+3",
    "<h1>+3</h1><p>+1<p>+1<p>+2<p>+1",
    "<table><tr><td><a href=/>-2</a><br><a href=/>-1</a><td><b>+5</b><p>+48<p>+20<p>+61</table><div class=nav><a href=/>-1</a></div>",
    "<ul><li><a href=/>-1</a><li><a href=/>-3</a><li><a href=/>-2</a></ul><div>+30</div><div>+3</div><div>+52</div><ul><li><a href=/>-4</a><li><a href=/>-2</a></ul>",
    # notices, logins, long furniture before and after
    "<div class=cookie-banner><p>-70<a href=/>-2</a></div><div class=cc-window>-44</div><article><h1>+6</h1><p>+38<p>+4</article><div class=user-feedback><p>-55<p>-3</div>",
    "<form>-2</form><div class=paywall><h2>-4</h2><p>-28</div><main><p>+18<p>+90<p>+2</main><footer><ul><li><a href=/>-2</a><li>-7</ul></footer>",
    "<header><h1>-2</h1><p>-9</header><div class=modal-login><p>-15</div><h2>+5</h2><p>+77<p>+30<p>+6<footer>-80</footer>",
    # pages of links
    "<div><a href=/>-6</a></div><div><a href=/>-4</a></div><div><a href=/>-7</a></div><div>-2</div><div><a href=/>-5</a></div>",
    "<h3>-2</h3><ul><li><a href=/>-3</a><li><a href=/>-4</a><li><a href=/>-2</a></ul><h3>-1</h3><ul><li><a href=/>-12</a><li><a href=/>-30</a></ul>",
    # lists and links within text
    "<article><h1>+4</h1><ul><li><a href=/>+3</a><li><a href=/>+2</a></ul><p>+1<ol><li>+20<li><a href=/>+12</a></ol><p><a href=/>+30</a></article><ul><li><a href=/>-2</a></ul>",
    "<nav><a href=/>-2</a></nav><article><h1>+1</h1><p>+4<p>+2</article><ul><li><a href=/>-2</a></ul>",
    "<article><p>+2<ul><li><a href=/>+8</a><li>+3<li><a href=/>+2</a></ul><p>+1<ul><li><a href=/>+5</a></ul></article>",
    "<main><h2>+2</h2><p><a href=/>+4</a><p>+3<p><a href=/>+1</a><h2>+1</h2><p><a href=/>+14</a></main><nav><a href=/>-14</a></nav>",
    "<article><p><a href=/>+2</a><h3>+3</h3><p><a href=/>+6</a> +1<p>+1<p><a href=/>+3</a></article><aside><p>-2<p>-60</aside>",
    "<div class=toolbar><p>-3</div><article><p>+1<p><a href=/>+1</a><p>+2<nav><p>-2<p>-9</nav><p>+1</article><form><p>-1<p>-4</form>",
    "<div><a href=/>-3</a></div><h1>+2</h1><p>+9<p>+40<div>-2</div><div><a href=/>-1</a></div><div><a href=/>-2</a></div>",
    "<h1>+5</h1><p>+44<p>+2 <a href=/>+10</a> +9<p>+36<div><a href=/>-1</a> <a href=/>-1</a> -1</div><p>+50",
)


def labelled(pages: tuple[str, ...] = PAGES) -> tuple[np.ndarray, np.ndarray]:
    """Measures and labels (1: main text) of the blocks of labelled pages."""
    rows, labels = [], []
    for page in pages:
        spelled = re.sub(r"(?<=[> ])([+-])(\d+)", lambda m: " ".join(["main" if m[1] == "+" else "rest"] * int(m[2])), page)
        found = blocks(spelled)
        rows.append(measure(found))
        labels += [int(b.text.startswith("main")) for b in found]
    return np.concatenate(rows), np.array(labels)


@dataclass(frozen=True)
class Node:
    """Rows with measure below limit go to low, others to high; a leaf has a label alone."""

    label: int
    measure: int = -1
    limit: float = 0.0
    low: Node | None = None
    high: Node | None = None

    def labels(self, rows: np.ndarray) -> np.ndarray:
        if self.measure < 0:
            return np.full(len(rows), self.label)
        below = rows[:, self.measure] < self.limit
        return np.where(below, self.low.labels(rows), self.high.labels(rows))


def grow(rows: np.ndarray, labels: np.ndarray, depth: int = 8, least: int = 1) -> Node:
    """A classification tree by Gini impurity. Ties: the first measure, then the lowest limit; label 1 in a leaf."""
    label = int(2 * labels.sum() >= len(labels))
    if depth == 0 or labels.min() == labels.max():
        return Node(label)
    best = None
    for k in range(rows.shape[1]):
        values = np.unique(rows[:, k])
        for limit in (values[1:] + values[:-1]) / 2:
            below = rows[:, k] < limit
            if min(below.sum(), (~below).sum()) < least:
                continue
            cost = sum(len(y) * (p := y.mean()) * (1 - p) for y in (labels[below], labels[~below]))
            if best is None or cost < best[0] - 1e-12:
                best = (cost, k, limit)
    if best is None:
        return Node(label)
    _, k, limit = best
    below = rows[:, k] < limit
    sides = (grow(rows[s], labels[s], depth - 1, least) for s in (below, ~below))
    return Node(label, k, float(limit), *sides)


@lru_cache(maxsize=1)
def default_tree() -> Node:
    return grow(*labelled())


def main_text(page: str | None, tree: Node | None = None) -> str:
    found = blocks(page) if page else []
    if not found:
        return ""
    keep = (tree or default_tree()).labels(measure(found))
    return "\n".join(b.text for b, y in zip(found, keep, strict=True) if y)


def extract(pages: DataFrame, html_col: str = "html", tree: Node | None = None) -> tuple[DataFrame, list[str]]:
    """Every row of pages with text and n_chars, its code points (underscores before names that pages has), and the two
    names. Null, empty and text-less pages have an empty text; repeated rows are read alike; whole pages of any length
    are read, in time that grows with their length alone; an empty table stays empty."""
    names = fresh(pages, "text", "n_chars")
    tree = tree or default_tree()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, html_col):
                texts = [main_text(h, tree) for h in part.column(html_col).to_pylist()]
                made = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays([*part.columns, *made], [*part.schema.names, *names])

    kinds = [T.StringType(), T.LongType()]
    return pages.mapInArrow(run, T.StructType([*pages.schema.fields, *map(T.StructField, names, kinds)])), names


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of pages: id, url, text, n_chars (see extract)."""
    out, (text, n) = extract(pages.select(id_col, url_col, html_col), html_col)
    return out.select(id_col, url_col, F.col(text).alias("text"), F.col(n).alias("n_chars"))


#: The same for pages whose main text is all in one plain article of headings and paragraphs, as in the table at hand.
#: A reference is decoded once, so the ampersand comes last.
_REFERENCES = (("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&#39;", "''"), ("&amp;", "&"))


def _decoded(c: str) -> str:
    for a, b in _REFERENCES:
        c = f"replace({c}, '{a}', '{b}')"
    return c


SQL = rf"""
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)(</article>|$)', 1) AS inner_html FROM pages),
l AS (SELECT page_id, url, string_split(regexp_replace(regexp_replace(regexp_replace(inner_html, '<br>', ' ', 'g'), '</?(p|h1)>', chr(0), 'g'), '<[^>]*(>|$)', '', 'g'), chr(0)) AS parts FROM a),
t AS (SELECT page_id, url, list_filter(list_transform(parts, lambda x: trim(regexp_replace({_decoded("x")}, '\s+', ' ', 'g'))), lambda x: x <> '') AS lines FROM l)
SELECT page_id, url, array_to_string(lines, chr(10)) AS text, CAST(length(array_to_string(lines, chr(10))) AS BIGINT) AS n_chars FROM t
"""
