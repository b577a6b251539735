"""Main text of web pages: parser events, text-to-tag ratio, smoothing, clustering.

The standard library's streaming HTML parser turns a page into lines: a line
ends wherever a block element starts or ends. Each line has its text, its
number of tags and the container elements it stands in. The text-to-tag ratios
along the page are smoothed by a Gaussian; lines above the threshold (a multiple
of the standard deviation) form the content clusters. The content region is all
article and main elements with such lines, if these hold most of their text,
else the innermost element that holds all of them and the top headings. The
region's lines (and top headings outside, if it has none) are the result, less what the clusters leave out of it:
runs of lines that are links throughout and whose smoothed ratios lie below the threshold (lists of other
pages; with the heading over them), and, where nothing narrower than the page's body holds the
content, all lines before its first and after its last cluster line. Also without lines inside elements that are never article text
(menus, headers, footers, asides, forms, scripts; class, id and role names of
adverts, notices, sidebars and reader comments). A form or a class or id name
does not count where the element holds the page's article, and words such as
header or notice do not count inside an article.

Defined cases: null or empty html, or a page without text, gives an empty text;
unclosed and stray tags are tolerated; character references are decoded; repeated
rows are each returned; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

#: Fixed values of HTML: elements without content, elements that end a line, elements that contain blocks.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTAINERS = frozenset("html body main article section div header footer nav aside form ul ol dl table tbody thead tfoot "
                       "tr figure details fieldset dialog menu search hgroup address".split())
BLOCKS = CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th blockquote pre hr caption figcaption summary legend "
                                "title option center".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Never article text.
SKIPPED = frozenset("head title script style noscript template svg math canvas iframe object audio video nav footer aside form "
                    "button select option textarea dialog menu search datalist".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: Words in class and id names of what surrounds an article.
AROUND = frozenset("nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toolbar masthead header footer "
                   "sidebar sidenav rail widget widgets related recommended recommendations share sharing social "
                   "newsletter subscribe subscription signup login search form".split())
#: Words that hold for articles, too.
FOREIGN = frozenset("ad ads advert adverts advertisement advertisements advertising sponsor sponsored promo promotion banner "
                    "cookie cookies consent gdpr notice notices alert alerts popup modal overlay disclaimer "
                    "comment comments commentlist reply replies respond disqus discussion".split())
#: Of these, words that inside an article name parts of it.
OWN = frozenset("header masthead notice notices alert alerts disclaimer".split())
#: Of these, words of what may hold more text than the article.
TALK = frozenset("comment comments commentlist reply replies respond disqus discussion".split())
#: Results of a look at an element: always foreign, foreign by a name (or a form), the same of reader comments.
SURE, NAMED, TALKED = 1, 2, 3
WORD = re.compile(r"[a-z]+")
#: A line is a link throughout from this share of its characters on.
LINKED = 0.9


class _Lines(HTMLParser):
    """Collects (text, tags, container, mark) per line; a mark is an element that looks foreign."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int, int]] = []          # element, container number, innermost mark (-1: none)
        self.parent, self.kind, self.mark_of = [-1], ["page"], [-1]     # per container
        self.outer, self.look, self.within = [], [], []     # per mark: the mark around it, why it is one, is it in an article
        self.lines: list[tuple[str, int, int, int]] = []
        self.heading: list[int] = []                        # per line: 1 to 6 for headings, else 0
        self.linked: list[float] = []                       # per line: share of its characters inside links
        self.text: list[str] = []
        self.tags = 0
        self.in_link, self.link_chars = False, 0

    def _where(self) -> tuple[int, int]:
        return (self.open[-1][1], self.open[-1][2]) if self.open else (0, -1)

    def end_line(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            self.lines.append((text, max(1, self.tags), *self._where()))
        elif self.tags:
            self.lines.append(("", self.tags, *self._where()))
        if len(self.heading) < len(self.lines):
            tag = self.open[-1][0] if self.open else ""
            self.heading.append(int(tag[1]) if tag in HEADINGS else 0)
            self.linked.append(self.link_chars / max(1, len("".join(text.split()))))
        self.text, self.tags, self.link_chars = [], 0, 0

    def _foreign(self, tag: str, attrs: list) -> int:
        inside = any(t in ("article", "main") for t, _, _ in self.open)
        if (tag in SKIPPED and tag != "form") or (tag == "header" and not inside):
            return SURE
        if tag in ("html", "body", "main"):
            return 0
        found = NAMED if tag == "form" else 0
        for name, value in attrs:
            if name == "hidden" or (name == "aria-hidden" and value == "true"):
                return SURE
            if name == "role" and value and value.lower() in ROLES:
                if value.lower() != "form":
                    return SURE
                found = found or NAMED
            if name == "style" and value and "display:none" in value.replace(" ", "").lower():
                return SURE
            if name in ("class", "id") and value:
                words = set(WORD.findall(value.lower())) - (OWN if inside else set())
                if words & FOREIGN or (tag != "article" and words & AROUND and not (inside and tag == "header")):
                    found = max(found, TALKED if words & TALK else NAMED)
        return found

    def handle_starttag(self, tag: str, attrs: list) -> None:
        block = tag in BLOCKS
        if block:
            self.end_line()
        self.tags += 1
        if tag == "br":
            self.text.append(" ")
        if tag == "a" or tag in CONTAINERS:
            self.in_link = tag == "a"
        if tag in VOID:
            return
        if block and tag not in CONTAINERS:                  # a block without blocks inside ends an open one
            while self.open and self.open[-1][0] in BLOCKS - CONTAINERS:
                self.open.pop()
        here, mark = self._where()
        foreign = self._foreign(tag, attrs) if tag in CONTAINERS or tag in SKIPPED or block or attrs else 0
        if foreign:
            self.outer.append(mark)
            self.look.append(foreign)
            self.within.append(any(t in ("article", "main") for t, _, _ in self.open))
            mark = len(self.outer) - 1
        if tag in CONTAINERS:
            self.parent.append(here)
            self.kind.append(tag)
            self.mark_of.append(mark)
            here = len(self.parent) - 1
        if block or foreign:
            self.open.append((tag, here, mark))

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in BLOCKS:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        block = tag in BLOCKS
        if block:
            self.end_line()
        self.tags += 1
        if tag == "a" or tag in CONTAINERS:
            self.in_link = False
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                if not block and "".join(self.text).strip():
                    self.end_line()                          # a skipped inline element's text is a line of its own
                del self.open[i:]
                break
            if self.open[i][0] in CONTAINERS and tag not in CONTAINERS:
                break                                        # a stray end tag closes nothing outside its container

    def handle_data(self, data: str) -> None:
        self.text.append(data)
        if self.in_link:
            self.link_chars += len("".join(data.split()))


def smooth(x: np.ndarray, sigma: float) -> np.ndarray:
    """Gaussian smoothing; the ends are extended by their own values."""
    r = max(1, int(3 * sigma))
    k = np.exp(-0.5 * (np.arange(-r, r + 1) / sigma) ** 2)
    return np.convolve(np.pad(x, r, mode="edge"), k / k.sum(), mode="valid")


def _chain(outer: list[int], i: int) -> Iterator[int]:
    while i >= 0:
        yield i
        i = outer[i]


def _skipped(p: _Lines, weight: np.ndarray) -> list[bool]:
    """Per mark: is it foreign? ``weight`` is the length of each line that has a high ratio, else 0.

    A name does not make an element foreign that holds the page's article: more
    text of article or main elements than stands outside all marks (for reader
    comments: where none does), or most of the text with a high ratio (for
    comments: all). The second does not hold for what stands beside an article.
    """
    sure = [False] * len(p.outer)
    for m, look in enumerate(p.look):                       # a mark is numbered after those around it
        sure[m] = look == SURE or (p.outer[m] >= 0 and sure[p.outer[m]])
    held, article, total, plain = np.zeros(len(p.outer)), np.zeros(len(p.outer)), 0.0, 0
    for (text, _, c, mark), w in zip(p.lines, weight):
        if not text or (mark >= 0 and sure[mark]):
            continue
        total += w
        held[list(_chain(p.outer, mark))] += w
        own = [k for k in _chain(p.parent, c) if p.kind[k] in ("article", "main")]
        if own and mark < 0:
            plain += len(text)
        # articles that are not marked themselves; the marks around any of them
        own = {m for k in own if p.mark_of[k] == p.mark_of[p.parent[k]] for m in _chain(p.outer, p.mark_of[k])}
        article[list(own)] += len(text)
    beside, foreign = plain > 0 or article.any(), [False] * len(p.outer)
    for m, look in enumerate(p.look):
        talk = look == TALKED
        own = (article[m] > plain and not (talk and plain)) or ((p.within[m] or not beside) and (held[m] == total > 0 if talk else held[m] > total / 2))
        foreign[m] = sure[m] or not own or (p.outer[m] >= 0 and foreign[p.outer[m]])
    return foreign


def main_text(html: str | None, sigma: float = 1.0, threshold: float = 1.0) -> str:
    """The article of a page, one line a block."""
    if not html:
        return ""
    p = _Lines()
    p.feed(html)
    p.close()
    p.end_line()
    if not p.lines:
        return ""
    length = np.array([len(text) for text, _, _, _ in p.lines], float)
    ratio = smooth(length / np.array([tags for _, tags, _, _ in p.lines], float), sigma)
    spread = ratio.std()
    high = ratio >= threshold * spread
    foreign = _skipped(p, np.where(high, length, 0))
    kept = [i for i, (text, _, _, mark) in enumerate(p.lines) if text and not (mark >= 0 and foreign[mark])]
    if not kept:
        return ""
    content = [i for i in kept if high[i]] or kept
    held = np.zeros(len(p.parent))
    for i in content:
        c = p.lines[i][2]
        while c >= 0:
            held[c] += length[i]
            c = p.parent[c]
    total = held[0]
    articles = {c for c in range(len(held)) if p.kind[c] in ("article", "main") and held[c]}
    texts = {i for i in content if any(c in articles for c in _chain(p.parent, p.lines[i][2]))}
    if length[list(texts)].sum() > total / 2:
        region = articles
        if not any(p.heading[i] == 1 for i in kept if any(c in articles for c in _chain(p.parent, p.lines[i][2]))):
            heads = {i for i in kept if p.heading[i] == 1}           # the headline stands outside
        else:
            heads = set()
    else:
        heads = {i for i in kept if p.heading[i] == 1}
        ways = [set(_chain(p.parent, c)) for c in {p.lines[i][2] for i in {*content, *heads}}]
        region = {max(set.intersection(*ways))}             # containers are numbered in page order
    inside = [i for i in kept if i in heads or any(c in region for c in _chain(p.parent, p.lines[i][2]))]
    if all(p.kind[c] in ("page", "html", "body") for c in region):
        ends = [k for k, i in enumerate(inside) if high[i] or p.heading[i] == 1]
        inside = inside[ends[0]:ends[-1] + 1] if ends else inside
    other = _link_lists(p, inside, ratio, threshold * spread)
    return "\n".join(p.lines[i][0] for k, i in enumerate(inside) if k not in other)


def _link_lists(p: _Lines, inside: list[int], ratio: np.ndarray, limit: float) -> set[int]:
    """Places in ``inside`` of two or more lines in a row that are links throughout (``LINKED``) and whose mean
    smoothed ratio is below the limit, and of a heading just over them."""
    out: set[int] = set()
    k = 0
    while k < len(inside):
        end = k
        while end < len(inside) and p.linked[inside[end]] >= LINKED and p.heading[inside[end]] != 1:
            end += 1
        if end - k >= 2 and ratio[inside[k:end]].mean() < limit:
            out.update(range(k, end))
            if k and p.heading[inside[k - 1]] > 1:
                out.add(k - 1)
        k = max(end, k + 1)
    return out


def extract(pages: DataFrame, html_col: str = "html", out: str = "text") -> DataFrame:
    """``pages`` without the html column, with the main text; every other column passes through."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array([main_text(h) for h in batch.column(0).to_pylist()], pa.string())],
                                             names=["row", "text"])

    rest = [c for c in pages.columns if c not in (html_col, out)]
    packed = pages.select(F.col(f"`{html_col}`").cast("string").alias("html"), F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row"))
    schema = StructType([packed.schema["row"], StructField("text", StringType())])
    return (packed.mapInArrow(run, schema)
            .select("row.*", F.col("text").alias(out)))
