"""Main text of HTML pages: parser events, text-to-tag ratios, Gaussian smoothing, threshold clustering.

The standard library's parser streams a page as events. Events make lines, the blocks of a page, each with its characters,
its tags, its linked characters and the container it stands in; parts that are never article text (scripts, menus, forms, adverts,
comments and the like, by element, role or class) make none. The ratio of text to tags of the lines is smoothed with a
Gaussian kernel and clustered by a threshold, its standard deviation; runs of lines above it are the content. The container
that holds most of the content is the article, and of it the region from the first content line to the last one is
selected, with the plain lines that adjoin it: a short paragraph between long ones has a low ratio, but it belongs to them.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements by their role in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PROSE = HEADINGS | {"p", "blockquote"}
BLOCKS = HEADINGS | frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "header html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
NEVER = frozenset("head script style noscript template iframe object svg math canvas audio video select button textarea "
                  "nav menu footer aside form dialog title".split())
ARTICLES = frozenset(("article", "main"))
#: Elements that a start tag of one of these names ends, if they are innermost.
ENDED_BY = {"li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "tr": ("tr", "td", "th", "p"),
            "td": ("td", "th", "p"), "th": ("td", "th", "p")}
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar "
                  "toolbar".split())
#: Words that name such parts as the first or the last word of a class or an id.
HINTS = frozenset(
    "ad ads adsense advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice "
    "notices notification alert newsletter subscribe subscription signup login popup modal overlay sidebar aside menu nav navbar "
    "navigation breadcrumb breadcrumbs footer header masthead topbar comment comments disqus replies respond share sharing social related "
    "recommended recommendations widget toolbar pagination pager search disclaimer copyright skip hidden".split())
#: First words after which a hint tells what a layout has, not what it is.
LAYOUT = frozenset("with has have no without".split())
HEADERS = frozenset(("header", "masthead", "banner"))
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

#: Lines on each side that the kernel covers, its standard deviation in lines, the share of linked characters of a menu,
#: and the share of content that a container needs for the search to go into it.
REACH = 2
SPREAD = 1.0
LINKED = 0.8
MOST = 0.9


@dataclass
class Line:
    """A block of text. ``tags`` counts the start tags in it, its own included."""

    text: str
    tags: int
    linked: int
    container: int
    in_article: bool
    kind: str


class _Reader(HTMLParser):
    """Makes lines of events. The stack holds the open blocks, and inline elements only where they are left out."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.stack: list[tuple[str, bool, int, bool]] = []  # name, left out, container, in an article
        self.open: Counter[str] = Counter()
        self.parents, self.kinds = [-1], [""]
        self.left_out, self.container, self.in_article = False, 0, False
        self.words: list[str] = []
        self.tags, self.linked, self.link, self.kind = 0, 0, False, ""

    def end_line(self) -> None:
        text = " ".join("".join(self.words).split())
        if text:
            self.lines.append(Line(text, max(1, self.tags), min(self.linked, len(text)), self.container, self.in_article,
                                   self.kind))
        self.words, self.tags, self.linked, self.link, self.kind = [], 0, 0, False, ""

    def push(self, tag: str, left_out: bool) -> None:
        self.stack.append((tag, self.left_out, self.container, self.in_article))
        self.open[tag] += 1
        self.left_out = left_out

    def pop(self) -> str:
        tag, self.left_out, self.container, self.in_article = self.stack.pop()
        self.open[tag] -= 1
        return tag

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.tags += 1
        if tag in VOID:
            if tag in ("br", "hr"):
                self.words.append(" ")
            return
        block = tag in BLOCKS
        if block:
            ends = ENDED_BY.get(tag, ("p", "head"))
            while self.stack and self.stack[-1][0] in ends:
                self.end_line()
                self.pop()
            if tag in ARTICLES or tag == "body":
                self.leave_unclosed()
        out = self.left_out or tag in NEVER or self.named_out(tag, attrs)
        if block:
            self.end_line()
            self.tags, self.kind = 1, tag
            self.push(tag, out)
            if tag not in ("p", *HEADINGS):
                self.parents.append(self.container)
                self.kinds.append(tag)
                self.container = len(self.parents) - 1
            self.in_article = self.in_article or tag in ARTICLES
        elif out:
            # what follows an inline part that is left out belongs to the line before it
            self.push(tag, True)
        elif tag == "a":
            self.link = True

    def leave_unclosed(self) -> None:
        """A part that was never closed does not swallow the article that follows it."""
        while self.stack and self.left_out and self.stack[-1][0] in NEVER | {"header", "ul", "ol", "li", "p"} and any(
                self.open[t] for t in ("nav", "head", "header", "form", "menu")):
            self.end_line()
            self.pop()

    def named_out(self, tag: str, attrs: list) -> bool:
        if tag in ("html", "body", "main"):
            return False
        given = {k: v or "" for k, v in attrs}
        if "hidden" in given or given.get("aria-hidden") == "true" or "display:none" in given.get("style", "").replace(" ", ""):
            return True
        if tag == "header" and not self.in_article or given.get("role", "").lower() in ROLES:
            return True
        for name in (*given.get("class", "").split(), given.get("id", "")):
            words = [w.lower() for w in WORDS.findall(name)]
            if not words or words[0] in LAYOUT:
                continue
            hint = {words[0], words[-1]} & HINTS
            if hint and not (self.in_article and hint <= HEADERS):
                return True
        return False

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag == "a":
            self.link = False
        if tag in BLOCKS:
            self.end_line()
            if tag == "p" and (not self.stack or self.stack[-1][0] != "p"):
                return
        elif not self.stack or self.stack[-1][0] != tag:
            # an inline end tag closes nothing but an open part of its own kind
            if not self.open[tag] or tag not in NEVER:
                return
        if self.open[tag]:
            while self.pop() != tag:
                pass

    def handle_data(self, data: str) -> None:
        if not self.left_out:
            self.words.append(data)
            if self.link:
                self.linked += len(data)


def lines_of(html: str) -> tuple[list[Line], list[int], list[str]]:
    """The lines of a page, and the parent and the element of each container."""
    reader = _Reader()
    reader.feed(html)
    if reader.rawdata.startswith("<!--"):  # a comment without an end lasts to the end of the page
        reader.rawdata = ""
    reader.close()
    reader.end_line()
    return reader.lines, reader.parents, reader.kinds


def smoothed(ratios: np.ndarray, reach: int = REACH, spread: float = SPREAD) -> np.ndarray:
    """Each ratio averaged with its neighbours by a Gaussian kernel, which is normalised at the edges."""
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / spread) ** 2)
    weights = np.convolve(np.ones(len(ratios)), kernel)[reach:len(ratios) + reach]
    return np.convolve(ratios, kernel)[reach:len(ratios) + reach] / weights


def _is_menu(line: Line) -> bool:
    return line.linked >= LINKED * len(line.text)


def _containers(lines: list[Line], content: np.ndarray, parents: list[int], kinds: list[str]) -> list[int]:
    """The containers whose content is the article: the outermost articles that hold content, or else the mains, or else
    the innermost container that holds nearly all content."""
    held = [0] * len(parents)
    for line, good in zip(lines, content):
        held[line.container] += len(line.text) if good else 0
    best = [-1] * len(parents)
    for c in range(len(parents) - 1, 0, -1):  # a container comes after its parent
        held[parents[c]] += held[c]
        if best[parents[c]] < 0 or held[c] >= held[best[parents[c]]]:
            best[parents[c]] = c
    for kind in ("article", "main"):
        inside, found = [False] * len(parents), []
        for c in range(1, len(parents)):
            inside[c] = inside[parents[c]] or kinds[c] == kind
            if inside[c] and not inside[parents[c]] and held[c]:
                found.append(c)
        if found:
            return found
    at = 0
    while best[at] >= 0 and held[best[at]] >= MOST * held[at]:
        at = best[at]
    return [at]


def select(lines: list[Line], parents: list[int], kinds: list[str]) -> list[Line]:
    """The lines of the article, in page order."""
    if not lines:
        return []
    plain = np.array([0 if _is_menu(line) else (len(line.text) - line.linked) / line.tags for line in lines])
    ratios = smoothed(plain)
    content = (ratios >= ratios.std()) & (plain > 0)
    inside = np.array([line.in_article for line in lines]) & (plain > 0)
    if inside.any():
        # where the page marks its article, the clusters of that text alone count
        content = content & inside if (content & inside).any() else inside
    elif not content.any():
        content = plain > 0
    region = [0] * len(parents)
    for c in _containers(lines, content, parents, kinds):
        region[c] = c + 1
    for c in range(1, len(parents)):
        region[c] = region[c] or region[parents[c]]
    by_region: dict[int, list[int]] = {}
    for i, line in enumerate(lines):
        if region[line.container] and not (_is_menu(line) and line.kind not in PROSE):
            by_region.setdefault(region[line.container], []).append(i)
    chosen: list[int] = []
    for members in by_region.values():
        spots = [n for n, i in enumerate(members) if content[i]]
        if spots:
            first, last = spots[0], spots[-1]
            while first > 0 and _adjoins(lines[members[first - 1]]):
                first -= 1
            while last + 1 < len(members) and _adjoins(lines[members[last + 1]]):
                last += 1
            chosen += members[first:last + 1]
    return [lines[i] for i in sorted(chosen)]


def _adjoins(line: Line) -> bool:
    return line.in_article or line.kind in PROSE and not _is_menu(line)


def main_text(html: str | None) -> str:
    """The article's text: white space is one space, and blocks are joined by one space. Empty if there is none."""
    return " ".join(line.text for line in select(*lines_of(html))) if html else ""


def _extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts = [main_text(html) for html in batch["html"]]
        yield pd.DataFrame({"page_id": batch["page_id"].astype("Int64"), "url": batch["url"], "text": texts,
                            "n_chars": [len(t) for t in texts]})


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page, from its whole html.

    A null or empty html, and one without text, has the empty text. White space is what Unicode calls so, no-break spaces
    included. Rows that repeat a page are extracted each on their own, with the same result. A page of any length is read
    in time that grows with its length; a task holds the pages of one Arrow batch. An empty table gives no rows; other
    columns are ignored.
    """
    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInPandas(
        _extract, "page_id long, url string, text string, n_chars long")
