"""Main text of web pages by text-to-tag ratios over a stream of parser events.

The standard library's parser gives events; block elements cut the page into lines. A line's ratio is
its characters per tag in it. Ratios are smoothed with a Gaussian over neighbouring lines, and a
threshold from their spread splits lines into content and others. The innermost container around
all content is the region that is kept, whole: short paragraphs between long ones belong to it.
Where it lies outside the articles of a page, these are kept whole, and content beside them.
Elements that name themselves menus, adverts, comments and the like take no part, unless one holds
most of the page's text outside links: then it is a wrapper, and its name says nothing.
"""

from __future__ import annotations

import math
import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedwell.llm.arrow import Out, rows_of

#: Elements that begin and end a line (fixed values, from the HTML standard).
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table "
    "tbody td tfoot th thead title tr ul".split()
)
#: Elements without an end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text is never part of the article.
SKIPPED = frozenset(
    "aside audio button canvas datalist dialog footer form head iframe input label map menu nav noframes noscript "
    "object optgroup option script search select style svg template textarea title video".split()
)
#: Words in a class, id or role that name such elements.
NAMES = frozenset(
    "ad ads advert advertisement advertising adverts alert banner breadcrumb breadcrumbs comment comments complementary "
    "consent contentinfo cookie cookies copyright dialog discussion disqus footer form gdpr login masthead menu "
    "menubar modal nav navbar navigation newsletter notice notification pager pagination paywall popup promo promotion "
    "promoted recommended related replies respond search share sharing shoutbox sidebar sidenav signup skip social "
    "sponsor sponsored subscribe subscription teaser toolbar topbar widget widgets".split()
)
#: Elements that a region may be.
CONTAINERS = frozenset("article main section div td body".split())
#: End tags that a new one of the same kind implies.
SINGLE = frozenset("p li dt dd tr td th option".split())
#: Standard deviation of the smoothing in lines, and the lines to each side that it reaches.
SIGMA, REACH = 1.0, 3
#: Standard deviations of the ratios that make the threshold.
SPREAD = 0.5
#: Share of the text outside links beyond which a named element is a wrapper; for one whose whole name is a listed word.
WRAPPER, WRAPPER_EXACT = 0.5, 0.75

#: Elements that never take part, and named ones: a listed word alone, or as part of a name.
_NEVER, _EXACT, _PART = range(3)
_TOKEN = re.compile(r"[a-z0-9]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class _Line:
    __slots__ = ("text", "tags", "path")

    def __init__(self, path: tuple):
        self.text: list[str] = []
        self.tags = 0
        self.path = path


class _Lines(HTMLParser):
    """Collects the lines outside skipped elements, each with the containers around it.

    ``wrappers`` are the numbers of start tags whose names are not looked at. What named elements
    hold is counted in ``held``: (number of the start tag, of the named element around, exact, characters).
    """

    def __init__(self, wrappers: frozenset = frozenset()):
        super().__init__(convert_charrefs=True)
        self.wrappers = wrappers
        self.tags = self.never = self.links = self.plain = 0  # start tags so far; open elements that never count; links; text outside them
        self.articles = 0
        self.held: list[list] = []
        self.named: list[int] = []  # open named elements, as places in ``held``
        self.stack: list[tuple] = []  # (tag, number of the container or None, (whether it is skipped, whether always))
        self.path: tuple = ()  # (number, tag) of the containers that are open
        self.skipped = 0
        self.numbers = 0
        self.lines = [_Line(())]

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if tag in VOID:
            if tag == "hr":
                self._cut()
            else:
                self.lines[-1].tags += 1
                if tag == "br":
                    self.lines[-1].text.append(" ")
            return
        if tag in SINGLE:
            self._end_single(tag)
        elif tag in BLOCKS:
            self._end_single("p")
        if tag in ("article", "main") and self.skipped and not self.articles:
            while self.stack:  # an advert or menu that was never ended does not hold the first article; comments may hold others
                self._pop()
        self.articles += tag == "article"
        never = tag in SKIPPED
        named = None if never else self._named(tag, attrs)
        if named in (_EXACT, _PART) and self.tags in self.wrappers:
            named = None
        never = never or named == _NEVER
        skip = never or named is not None
        if skip and not never:
            self.held.append([self.tags, self.named[-1] if self.named else None, named == _EXACT, 0])
            self.named.append(len(self.held) - 1)
        self.never += never
        self.links += tag == "a"
        number = None
        if tag in CONTAINERS:
            self.numbers += 1
            number = self.numbers
            self.path += ((number, tag),)
        self.stack.append((tag, number, (skip, never)))
        self.skipped += skip
        if tag in BLOCKS:
            self._cut()
        self.lines[-1].tags += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if not any(t == tag for t, _, _ in self.stack):
            return
        self.lines[-1].tags += 1
        while self.stack[-1][0] != tag:
            self._pop()
        self._pop()

    def handle_data(self, data):
        if not self.never and not self.links:
            if self.named:
                self.held[self.named[-1]][3] += len(data.strip())
            self.plain += len(data.strip())
        if not self.skipped:
            self.lines[-1].text.append(data)

    def _pop(self):
        tag, number, (skip, never) = self.stack.pop()
        self.skipped -= skip
        self.never -= never
        self.links -= tag == "a"
        if skip and not never:
            self.named.pop()
        if number is not None:
            self.path = self.path[:-1]
        if tag in BLOCKS:
            self._cut()

    def _cut(self):
        if self.lines[-1].text:
            self.lines.append(_Line(self.path))
        else:
            self.lines[-1].path = self.path

    def _end_single(self, tag):
        """A new paragraph, item or cell ends the one before in the same list, table or container."""
        for n in range(len(self.stack) - 1, -1, -1):
            open_tag = self.stack[n][0]
            if open_tag == tag:
                while len(self.stack) > n:
                    self._pop()
                return
            if open_tag in BLOCKS and open_tag not in SINGLE:
                return

    def wrapping(self) -> frozenset:
        """Named elements that hold most of the text outside links."""
        sizes = [h[3] for h in self.held]
        for n in range(len(sizes) - 1, -1, -1):  # an element comes after the one around it
            if (around := self.held[n][1]) is not None:
                sizes[around] += sizes[n]
        return frozenset(
            h[0] for h, size in zip(self.held, sizes) if size > (WRAPPER_EXACT if h[2] else WRAPPER) * self.plain)

    def _named(self, tag, attrs) -> int | None:
        """Whether the element is hidden, or named as one that takes no part."""
        inside = any(t in ("article", "main") for t, _, _ in self.stack)
        if tag in ("body", "html", "article", "main"):
            return None
        if tag == "header":
            return None if inside else _NEVER
        found = None
        for key, value in attrs:
            if key == "hidden" or key == "aria-hidden" and value == "true":
                return _NEVER
            if key == "style" and value and _HIDDEN.search(value):
                return _NEVER
            if key in ("class", "id", "role") and value:
                words = set(_TOKEN.findall(value.lower()))
                if words & NAMES or not inside and "header" in words:
                    exact = set(value.lower().split()) & (NAMES | {"header"})
                    found = _EXACT if exact or found == _EXACT else _PART
        return found


def smoothed(ratios: list[float]) -> list[float]:
    """Gaussian mean of each value and its neighbours."""
    kernel = [math.exp(-(k * k) / (2 * SIGMA * SIGMA)) for k in range(-REACH, REACH + 1)]
    out = []
    for n in range(len(ratios)):
        low, high = max(0, n - REACH), min(len(ratios), n + REACH + 1)
        weights = kernel[low - n + REACH : high - n + REACH]
        out.append(sum(w * r for w, r in zip(weights, ratios[low:high])) / sum(weights))
    return out


def _read(html: str, wrappers: frozenset = frozenset()) -> _Lines:
    parser = _Lines(wrappers)
    parser.feed(html)
    parser.close()
    return parser


def main_text(html: str) -> str:
    """The article's blocks, joined by blank lines; empty when the page has none."""
    parser = _read(html)
    if wrappers := parser.wrapping():
        parser = _read(html, wrappers)
    lines = [(" ".join("".join(x.text).split()), x.tags, x.path) for x in parser.lines if x.text]
    lines = [x for x in lines if x[0]]
    if not lines:
        return ""
    raw = [len(text) / max(1, tags) for text, tags, _ in lines]
    ratios = smoothed(raw)
    mean = sum(ratios) / len(ratios)
    least = min(SPREAD * math.sqrt(sum((r - mean) ** 2 for r in ratios) / len(ratios)), max(ratios))
    # Smoothing lifts short lines beside content, also those outside; they do not say where the region lies.
    content = [min(own, ratio) >= least for own, ratio in zip(raw, ratios)]
    if not any(content):
        content = [ratio >= least for ratio in ratios]
    regions, beside = _regions([path for (_, _, path), own in zip(lines, content) if own])
    return "\n\n".join(
        text for (text, _, path), own in zip(lines, content)
        if regions is None or beside and own or not regions.isdisjoint(path))


def _regions(paths: list[tuple]) -> tuple[set | None, bool]:
    """The containers that are kept (None: everything), and whether content outside them is."""
    first, last = min(paths), max(paths)  # what these two share, all share
    common = next((n for n, (a, b) in enumerate(zip(first, last)) if a != b), min(len(first), len(last)))
    for tag in ("article", "main"):
        for container in reversed(first[:common]):
            if container[1] == tag:
                return {container}, False
    # Content lies in several articles, or beside them.
    outer = {next((c for c in path if c[1] in ("article", "main")), None) for path in paths} - {None}
    if outer:
        return outer, True
    return ({first[common - 1]} if common else None), False


_TEXTS = "page_id long, url string, text string, n_chars long"


def extract_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, the main text (empty: none) and its code points, of every row.

    Null html counts as empty; null ids and urls stay; repeated rows are kept; an empty table gives
    no rows; other columns take no part. Broken markup is read as far as it goes.
    """
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches):
        out = Out(schema)
        for key, address, page in rows_of(batches, "page_id", "url", "html", step=64):
            text = main_text(page or "")
            if out.add((key, address, text, len(text)), len(text)):
                yield out.batch()
        yield out.batch()

    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    return rows.mapInArrow(run, _TEXTS)
