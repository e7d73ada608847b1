"""Operator 7, HTML extraction by line-block distribution.

Markup is stripped into lines: each block tag ends a line, so tags without text between them leave empty lines, and the
farther apart two blocks are in the page's structure, the more empty lines lie between them. Only what can never be text
is stripped with its markup: scripts, styles, templates, form controls, embedded objects, comments, the head's title.

A line's size is its text outside links, and none where most of it is links, unless it is a heading. The sizes are summed
over windows of WINDOW lines. A surge point is where the sum leaves zero, the dive point where it comes back to zero; the
lines between them are a run. Runs are kept by a threshold taken from the page: SURGE characters, or a quarter of its
largest run if that is less. A run between two that are kept stays as well, and a kept run keeps all its lines.

Marks only weigh and space the lines; they keep or drop none by themselves. An article or main element is set off by
WINDOW empty lines from what is around it, and inside it plain tags leave no more than its windows bridge. An element
marked as no part of an article (nav, aside, footer, form, dialog, menu, a header outside article and main, the same as
roles, or class and id names all of whose parts are MARKS or GLUE) is a column of lines of its own, beside those around
it, so that an advert doesn't cut an article in two; in such a column a run counts a MARKED-th of its size, and needs
SURGE and the largest other run's size.

In the text, character references are decoded, white space inside a block becomes one space, ends are trimmed, and
blocks are joined in page order by one space. Nothing is cut off.

Defined results: null or empty html and pages without text give an empty string; an unclosed comment or raw-text element
ends with the page, an unclosed control or embedded object holds nothing; a tag that the page's end cuts is dropped; unclosed elements end with their parent; an end tag that
DEPTH open elements or more separate from its start is ignored; rows with a null page_id or url stay; repeated rows each
stay; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm import common

WINDOW, SURGE, MARKED, DEPTH = 5, 120, 16, 256
RESULT = "page_id long, url string, text string, n_chars long"

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
#: Elements that hold no text of a page, up to their end tag whatever lies between.
CONTROLS = frozenset("select button object canvas audio video datalist".split())
RAW = CONTROLS | frozenset("script style textarea title noscript template iframe noframes xmp svg math".split())
#: Where such an element ends; one of CONTROLS also at the next start of its kind.
RAW_END = {x: re.compile(f"<(/{'?' * (x in CONTROLS)}){x}(?![^\\s/>])[^>]*>?", re.I) for x in sorted(RAW)}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that don't break a line.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img input".split())
CONTAINER = frozenset("html body article main section div td th table blockquote figure".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: What a start tag of these closes, if it is open above the nearest container or list.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
LISTS = frozenset("ul ol dl".split())
MARKED_TAGS = frozenset("nav footer aside form dialog menu".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
#: Words that name what is no part of an article: menus, headers, footers, sidebars, notices, adverts, forms, comments.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertisements sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs pagination pager toolbar masthead header footer sidebar aside "
    "widget cookie cookies consent gdpr notice notices notification popup modal newsletter subscribe subscription signup login search social sharing comment comments disqus replies copyright form".split()
)
#: Words beside which these still name it.
GLUE = frozenset("site page top bottom main global primary secondary list box block bar wrap wrapper container inner area section the".split())


def marked(tag: str, attributes: str, inside: bool) -> bool:
    """Whether an element is marked as no part of an article."""
    if tag in MARKED_TAGS or tag == "header" and not inside:
        return True
    if tag in ("html", "body", "main", "article") or "=" not in attributes:
        return False
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values).lower()
        if name == "role" and value in ROLES:
            return True
        if name in ("class", "id"):
            for one in value.split():
                words = set(re.findall("[a-z]+", one))
                if words & MARKS and words <= MARKS | GLUE and not (inside and words & MARKS == {"header"}):
                    return True
    return False


class Column:
    """Lines of one flow of text: their sizes, empty ones included, and of those with text its place in the page and itself."""

    def __init__(self, weight: int) -> None:
        self.weight, self.empty = weight, 0
        self.sizes: list[int] = []
        self.texts: dict[int, tuple[int, str]] = {}

    def add(self, text: tuple[int, str], size: int) -> None:
        self.texts[len(self.sizes)] = text
        self.sizes.append(size)
        self.empty = 0

    def gap(self, n: int) -> None:
        """At least n empty lines at the end."""
        if n > self.empty:
            self.sizes += [0] * (n - self.empty)
            self.empty = n


class Page:
    """Strips a page into columns of lines."""

    def __init__(self, html: str) -> None:
        self.columns = [Column(1)]
        self.stack: list[tuple[str, Column, bool]] = []  # tag, its column, whether in article or main
        self.open: Counter[str] = Counter()
        self.parts: list[str] = []
        self.linked = self.lines = 0
        self.links = 0  # depth of the open link, plus one
        self.read(html)

    @property
    def column(self) -> Column:
        return self.stack[-1][1] if self.stack else self.columns[0]

    @property
    def inside(self) -> bool:
        return bool(self.stack) and self.stack[-1][2]

    def line(self, empty: bool = True) -> None:
        """Ends a line; one without text is an empty line (in an article, up to what a window bridges)."""
        column = self.column
        text = " ".join("".join(self.parts).split()) if self.parts else ""
        if text:
            links = self.linked if not self.headings else 0
            column.add((self.lines, text), len(text) if 2 * links <= len(text.replace(" ", "")) else 0)
            self.lines += 1
        elif empty and column.texts and not (self.inside and column.empty >= WINDOW - 1):
            column.gap(column.empty + 1)
        self.parts, self.linked = [], 0

    def leave(self, k: int) -> None:
        """Closes the elements from place k of the stack on."""
        for tag, _, _ in self.stack[k:]:
            self.open[tag] -= 1
        bounds = any(tag in ("article", "main") for tag, _, _ in self.stack[k:])
        del self.stack[k:]
        if k + 1 < self.links:
            self.links = 0
        if bounds:
            self.column.gap(WINDOW)

    @property
    def headings(self) -> bool:
        """Whether a heading is open whose links count as text: any in an article, else an h1."""
        return self.open["h1"] > 0 or self.inside and any(self.open[x] for x in HEADINGS)

    def place(self, tags: tuple[str, ...], stop: frozenset[str]) -> int:
        """Place of the innermost open one of tags, none of stop being in between, or -1."""
        if not any(self.open[t] for t in tags):
            return -1
        for k in range(len(self.stack) - 1, max(len(self.stack) - DEPTH, 0) - 1, -1):
            if self.stack[k][0] in tags:
                return k
            if self.stack[k][0] in stop:
                return -1
        return -1

    def read(self, html: str) -> None:
        at, n, unclosed = 0, len(html), set()
        while at < n:
            m = TAG.search(html, at)
            if text := html[at : m.start() if m else n]:
                text = unescape(text) if "&" in text else text
                self.parts.append(text)
                if self.links:
                    self.linked += len("".join(text.split()))
            if not m:
                break
            at = m.end()
            slash, tag, attributes = m.group(1), m.group(2), m.group(3)
            if tag is None:
                slash, tag, attributes = m.group(4), m.group(5), m.group(6)
                if tag is None or not m.group(0).endswith(">"):
                    continue  # a comment or declaration, or cut off by the end
            tag = tag.lower()
            if tag == "a":
                self.links = 0 if slash else len(self.stack) + 1
            if tag in INLINE:
                continue
            self.line(empty=tag != "br")
            if slash:
                if tag == "body" or tag == "html":
                    continue
                k = self.place((tag,), frozenset() if tag in CONTAINER or tag in LISTS or tag in MARKED_TAGS or tag == "header" else CONTAINER)
                if k >= 0:
                    self.leave(k)
            elif tag in RAW:
                if not attributes.endswith("/") and tag not in unclosed:
                    end = RAW_END[tag].search(html, at)
                    if end:
                        at = end.start() if tag in CONTROLS and not end.group(1) else end.end()
                    elif tag in CONTROLS:
                        unclosed.add(tag)
                    else:
                        at = n
            elif tag not in VOID:
                self.start(tag, attributes)
        self.line()

    def start(self, tag: str, attributes: str) -> None:
        if self.stack and self.stack[-1][0] == "p":
            self.leave(len(self.stack) - 1)
        if tag in CLOSES and (k := self.place(CLOSES[tag], (CONTAINER | LISTS) - set(CLOSES[tag]))) >= 0:
            while k and self.stack[k - 1][0] in CLOSES[tag]:
                k -= 1
            self.leave(k)
        column, inside = self.column, self.inside
        if marked(tag, attributes, inside):
            column = Column(MARKED)
            self.columns.append(column)
        elif tag in ("article", "main"):
            column.gap(WINDOW)
            inside = True
        self.stack.append((tag, column, inside))
        self.open[tag] += 1


def runs(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """First and last line, with text, between a surge and its dive: sums over WINDOW lines that never are zero."""
    total = [0, *accumulate(sizes)]
    sums = [total[k + 1] - total[max(k + 1 - WINDOW, 0)] for k in range(len(sizes))]
    start = last = None
    for k, size in enumerate(sizes):
        if size:
            start, last = k if start is None else start, k
        if start is not None and (not sums[k] or k + 1 == len(sizes)):
            yield start, last
            start = None


def extract(html: str | None) -> str:
    """The main text of a page."""
    page = Page(html or "")
    found = [(c, [(a, b, sum(c.sizes[a : b + 1])) for a, b in runs(c.sizes)]) for c in page.columns]
    most = max((size for c, own in found if c.weight == 1 for _, _, size in own), default=0)
    kept: list[tuple[int, str]] = []
    for c, own in found:
        least = min(SURGE, most / 4) if c.weight == 1 else max(SURGE, most)
        strong = [k for k, (_, _, size) in enumerate(own) if size >= least * c.weight]
        for a, b, _ in own[strong[0] : strong[-1] + 1] if strong else []:
            kept += [c.texts[k] for k in range(a, b + 1) if k in c.texts]
    return " ".join(text for _, text in sorted(kept))


def main_text(pages: DataFrame) -> DataFrame:
    """RESULT of every row of pages (page_id, url, html)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in common.slices(batch, column=2):
                text = [extract(x.decode("utf-8", "replace")) for x in some.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array(text, pa.string()), pa.array(map(len, text), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), common.utf8("html")).mapInArrow(run, RESULT)
