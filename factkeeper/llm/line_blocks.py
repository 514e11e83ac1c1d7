"""Main text of HTML pages by line-block distribution.

The markup is stripped into lines, one for each block of text. An edge of a container (anything
but a paragraph, heading or the like) leaves an empty line. A line weighs its length without the
text of links; lines of menus, headers, footers, sidebars, notices, adverts, forms and reader
comments weigh nothing. Over windows of ``WINDOW`` lines the weights are summed. The text
surges where the sum reaches the threshold, ``SURGE`` characters or the page's largest sum if
that is smaller, and dives where it falls below; what lies between the first surge and the last
dive is kept, but for the lines that weigh nothing.

Where a page marks its article (``article``, else ``main`` or ``itemprop=articleBody``), what
is outside weighs nothing, links inside count, and the threshold is one character: the mark says
where the article is, however short, so all of it lies between surge and dive.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factkeeper.llm.common import text_slices

WINDOW = 3
SURGE = 120

# Elements of HTML by how they are read.
DROPPED = frozenset("script style noscript template iframe object embed svg math canvas audio video map select option datalist "
                    "button textarea head title".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
ASIDE = frozenset("nav header footer aside form menu dialog fieldset".split())
BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote figcaption address tr caption summary hr center".split())
CONTAINERS = frozenset("html body div section article main table thead tbody tfoot ul ol dl figure details hgroup search".split()) | ASIDE
VOID = frozenset("area base br col embed hr img input link meta source track wbr param".split())
MARKED = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements whose end is left out; a new one of the list ends them.
SELF_ENDING = {"p": frozenset(["p"]), "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
               "tr": frozenset(["tr", "td", "th"]), "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"])}
# Words of class, id and role that name what isn't the article.
ASIDE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promos promotion "
    "nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager sitenav topnav "
    "sidebar sidebars aside widget widgets related recommended recommendations "
    "header masthead topbar footer copyright colophon contentinfo complementary "
    "cookie cookies consent gdpr notice notices notification banner alert popup modal overlay toast newsletter subscribe subscription paywall "
    "comment comments commentlist reply replies respond disqus discussion "
    "share sharing social login signin signup register search searchbox toolbar skip form".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*\"[^\"]*\"|=\s*'[^']*'|=)*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s>]+)))?")
_NAME = re.compile(r"[a-z]+|[A-Z][a-z]*|[0-9]+")


@dataclass
class Line:
    text: str
    links: int
    group: int       # containers' edges come between groups
    aside: bool
    marked: int      # number of the article that it is in, 0 for none
    heading: bool


@dataclass
class _Open:
    tag: str
    aside: bool
    dropped: bool
    marked: int
    link: bool


@dataclass
class _Reader:
    """The page as lines, read token by token."""

    hints: bool
    lines: list[Line] = field(default_factory=list)
    stack: list[_Open] = field(default_factory=lambda: [_Open("", False, False, 0, False)])
    parts: list[str] = field(default_factory=list)
    links: int = 0
    group: int = 0
    marks: list[str] = field(default_factory=lambda: [""])   # the tag of each marked article, by number
    heading: bool = False

    def text(self, raw: str) -> None:
        at = self.stack[-1]
        if at.dropped:
            return
        said = html.unescape(raw)
        self.parts.append(said)
        if at.link:
            self.links += len("".join(said.split()))

    def end_line(self) -> None:
        if self.parts:
            said = " ".join("".join(self.parts).split())
            if said:
                at = self.stack[-1]
                self.lines.append(Line(said, self.links, self.group, at.aside, at.marked, self.heading))
            self.parts = []
        self.links = 0

    def start(self, tag: str, attrs: str) -> None:
        if tag in SELF_ENDING:
            self._end_among(SELF_ENDING[tag])
        if tag in BLOCKS or tag in CONTAINERS:
            if tag in BLOCKS and self.stack[-1].tag == "p":
                self._end_among(SELF_ENDING["p"])
            self.end_line()
            self.group += tag in CONTAINERS
            self.heading = tag in HEADINGS
        elif tag in ("br", "td", "th"):
            self.parts.append(" ")
        if tag in VOID:
            return
        at = self.stack[-1]
        marked, aside, dropped = at.marked, at.aside, at.dropped or tag in DROPPED
        known = _attributes(attrs) if attrs.strip(" /\n\t\r") else {}
        article = tag in MARKED or "articlebody" in known.get("itemprop", "").lower() or known.get("role", "") in ("main", "article")
        inner = tag == "article" and self.marks[marked] == "article"
        if inner and any(row.marked == marked and not row.aside for row in self.lines):
            aside = True   # an article in an article, below its text, is a comment
        elif article and not aside and not inner and (not marked or tag == "article"):
            self.marks.append(tag)
            marked = len(self.marks) - 1
        elif tag in ASIDE:
            aside = True
        elif self.hints and not article and tag not in ("html", "body") and _names_aside(known):
            aside = True
        dropped = dropped or "hidden" in known or re.search(r"display\s*:\s*none", known.get("style", "")) is not None
        if tag in HEADINGS and marked and any(o.tag == "header" and o.marked for o in self.stack[-2:]):
            aside = False   # an article's own header holds its title
        self.stack.append(_Open(tag, aside, dropped, marked, at.link or tag == "a"))

    def _end_among(self, tags: frozenset[str]) -> None:
        """End an element that the next one ends, if it is open in this container."""
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k].tag in tags:
                self.end(self.stack[k].tag)
                return
            if self.stack[k].tag in CONTAINERS:
                return

    def end(self, tag: str) -> None:
        if tag == "p" and not any(o.tag == "p" for o in self.stack) or tag == "br":
            self.end_line()
            return
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k].tag == tag:
                break
            if tag not in CONTAINERS and self.stack[k].tag in CONTAINERS:
                return
        else:
            return
        if any(o.tag in BLOCKS or o.tag in CONTAINERS for o in self.stack[k:]):
            self.end_line()
            self.group += any(o.tag in CONTAINERS for o in self.stack[k:])
        elif tag in ("td", "th"):
            self.parts.append(" ")
        if tag in HEADINGS:
            self.heading = False
        del self.stack[k:]


def _attributes(attrs: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(attrs)}


def _names_aside(known: dict[str, str]) -> bool:
    """Whether class, id or role names something beside the article. ``with-sidebar`` and the
    like say what a wrapper has, not what it is."""
    for name in (known.get("class", "") + " " + known.get("id", "") + " " + known.get("role", "") + " " + known.get("aria-label", "")).split():
        words = [w.lower() for w in _NAME.findall(name)]
        if words and words[0] not in ("with", "has", "no", "without", "is") and "content" not in words[1:] and "wrap" not in words[-1] \
                and any(w in ASIDE_NAMES for w in words):
            return True
    return known.get("aria-hidden", "") == "true"


def lines(page: str, hints: bool = True) -> tuple[list[Line], list[str]]:
    """The page's lines, and the tag of each number of ``marked``; ``hints``: class, id and role
    tell what isn't the article."""
    r = _Reader(hints)
    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        if m is None:
            r.text(page[at:])
            break
        if m.start() > at:
            r.text(page[at:m.start()])
        at = m.end()
        if m[1] is not None:
            r.text(html.escape(m[1]))
        elif m[3]:
            tag = m[3].lower()
            if m[2]:
                r.end(tag)
                continue
            r.start(tag, m[4])
            if tag in RAW and not m[4].rstrip().endswith("/"):
                # raw text: nothing but its own end tag ends it
                end = re.compile(f"</{re.escape(tag)}\\s*[^>]*(?:>|$)", re.I).search(page, at)
                at = end.end() if end else n
                r.end(tag)
    r.end_line()
    return r.lines, r.marks


def _menu(rows: list[Line]) -> bool:
    """A group of lines that are links and nothing else."""
    return len(rows) > 1 and all(row.links >= len(row.text.replace(" ", "")) for row in rows)


def between(weights: np.ndarray, groups: np.ndarray, surge: int = SURGE) -> np.ndarray:
    """The lines between surge and dive points. ``weights`` are those of the lines; empty lines
    stand between ``groups``."""
    if not weights.any():
        return np.zeros(len(weights), dtype=bool)
    at = np.arange(len(weights)) + np.append(0, np.cumsum(np.minimum(np.diff(groups), WINDOW)))
    spread = np.zeros(at[-1] + WINDOW, dtype=np.int64)
    spread[at] = weights
    sums = np.convolve(spread, np.ones(WINDOW, dtype=np.int64))[WINDOW - 1:][:at[-1] + 1]   # of the window from each line on
    least = min(surge, int(sums.max()))
    # a window may reach over an edge: its own group must hold half of what makes a surge
    number = np.cumsum(np.append(True, np.diff(groups) != 0)) - 1
    holds = np.bincount(number, weights)[number] * 2 >= least
    high = np.flatnonzero((sums[at] >= least) & (weights > 0) & holds)
    if not len(high):
        return weights == weights.max()
    last = number == number[high[-1]]   # the windows behind the last surge reach to its group's end
    inside = np.arange(len(weights))
    return (weights > 0) & (inside >= high[0]) & (inside <= np.flatnonzero(last)[-1])


def main_text(page: str | None) -> str:
    """The article's blocks in page order, joined by two line breaks."""
    if not page:
        return ""
    rows, marks = lines(page)
    if rows and all(r.aside for r in rows):
        rows, marks = lines(page, hints=False)   # the names cover the whole page: they say nothing
    groups: dict[int, list[Line]] = {}
    for r in rows:
        groups.setdefault(r.group, []).append(r)
    menus = {g for g, rs in groups.items() if _menu(rs)}
    there = {r.marked for r in rows if r.marked and not r.aside}
    articles = {m for m in there if marks[m] == "article"} or there

    def weight(r: Line) -> int:
        if r.aside or r.group in menus or articles and r.marked not in articles:
            return 0
        return len(r.text) if articles or r.heading else max(0, len(r.text) - r.links)

    weights = np.array([weight(r) for r in rows], dtype=np.int64)
    kept = between(weights, np.array([r.group for r in rows], dtype=np.int64), 1 if articles else SURGE)
    first = int(kept.argmax()) if kept.any() else 0
    while first and rows[first - 1].heading and weights[first - 1]:   # the headings right above the text
        first -= 1
        kept[first] = True
    return "\n\n".join(r.text for r, k in zip(rows, kept) if k)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages(page_id, url, html)``.

    A null or empty ``html``, or one without text, gives an empty text; null ids and urls are
    passed through. Repeated rows give repeated rows; an empty table gives an empty one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in text_slices(iter([batch]), "html"):
                texts = [main_text(page) for page in b.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html")).mapInArrow(run, "page_id long, url string, text string, n_chars long")
