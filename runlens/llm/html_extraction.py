"""Main text of web pages.

The page is read as the event stream of the standard library's HTML parser.
Block tags end a line; each line carries its text, the number of tags met
while it grew, its link text and the container it stands in.
Content regions are then selected in three steps:

1. text-to-tag ratio per line, with link text and lines of furniture
   (navigation, adverts, forms, ...) counted as no text;
2. the ratios smoothed by a Gaussian kernel along the page, so that a short
   paragraph between long ones keeps their level;
3. threshold clustering: two-means over the log of the smoothed ratios; the
   lines of the upper cluster mark the content.

The region is the page's ``article`` elements where they hold most of the
marked text, else ``main`` where it holds any, else the deepest container that
holds most of it, else the page. Marked
lines beside the region (within ``main``, if that is the region) join it with
their own container. Every line of the region is kept, whatever its own ratio,
but for furniture inside it and, outside an article, lines that are several
links and nothing else. Formulas, and the words on buttons in an article, are
text. Work and memory grow with the page, however deep it nests.

Defined results: null, empty or text-free pages give the empty string; a page
without any upper cluster keeps all its lines that are not furniture;
unclosed or truncated markup is read as far as it goes.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches

# Element names by their part in a page (HTML living standard).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split())
NO_TEXT = frozenset("script style template noscript iframe object svg canvas audio video map select option "
                    "textarea button input datalist head title".split())
FURNITURE = frozenset("nav footer aside form menu dialog fieldset".split()) | NO_TEXT
REGIONS = frozenset(["article", "main"])
#: Elements that hold blocks of text; the others (paragraphs, headings, list items) are such blocks.
CONTAINERS = REGIONS | frozenset("html body div section center form table tbody tr td".split())
#: Elements that are furniture on a page, but text in an article ("press <button>Save</button>").
CONTROLS = frozenset(["button"])
#: Elements whose end tag may be left out: a new one of the same kind ends an open one.
IMPLIED_END = frozenset("p li dt dd tr td th option".split())
# Words in class, id and role values that name page furniture.
FURNITURE_WORDS = frozenset(
    "ad ads adv advert advertisement advertising adbox adsense banner sponsor sponsored promo promotion sidebar "
    "aside menu nav navbar navigation breadcrumb breadcrumbs topbar toolbar header masthead footer cookie cookies "
    "consent gdpr notice notification alert popup modal overlay subscribe subscription newsletter signup login "
    "search form share sharing social related recommended pagination pager comment comments commentlist disqus "
    "respond reply replies complementary contentinfo widget skip sitemap copyright disclaimer".split())
#: Words that say an element is the page's frame or text, though it names furniture too ("page-with-sidebar").
FRAME_WORDS = frozenset("with has no without content main page layout wrapper container article post entry body".split())
#: Words that name furniture only outside an article ("article > .entry-header" holds its headline, ".alert" a remark).
HEADER_WORDS = frozenset("header masthead search alert notice notification".split())
#: Words that a token which names furniture and nothing else may have besides ("share-buttons", not "related-work").
PART_WORDS = frozenset("area bar bottom box block button buttons icons inline items left link links list panel posts "
                       "right section slot stories top unit wide".split())
#: Elements whose ids are made from headings, and say what the text is about.
TITLED = frozenset("h1 h2 h3 h4 h5 h6 p li dt dd".split())
WORD = re.compile(r"[a-z]+|[A-Z][a-z]*|[A-Z]+(?![a-z])")


def names_furniture(tag: str, attrs: list[tuple[str, str | None]], in_region: bool) -> bool:
    """True for an element that is hidden or that its class, id or role calls furniture. In an article, and for the
    ids of sections, a token has to name furniture as a whole; ids of headings and text, and of an article's
    sections, say nothing."""
    section = tag == "section" or any(n == "class" and "section" in (v or "").lower().split() for n, v in attrs)
    for name, value in attrs:
        if name in ("hidden", "aria-hidden") and value != "false":
            return True
        if name in ("class", "id", "role") and value:
            if name == "id" and (tag in TITLED or (section and in_region)):
                continue
            for token in value.split():
                words = {w.lower() for w in WORD.findall(token)}
                if words & FRAME_WORDS and not words & {"comment", "comments", "ad", "ads", "footer"}:
                    continue
                named = words & (FURNITURE_WORDS - HEADER_WORDS if in_region else FURNITURE_WORDS)
                if tag == "form":
                    named -= {"form"}
                if named and (words <= FURNITURE_WORDS | PART_WORDS or not (in_region or (name == "id" and section))):
                    return True
    return False


def letters(text: str) -> int:
    """Letters and digits of a text."""
    return sum(map(str.isalnum, text))


class Lines(HTMLParser):
    """Parser events gathered into lines: (text, tags, link characters, container, furniture, links). A line knows its
    innermost container and a container its parent, so deep nesting costs no more than flat. A form is furniture
    unless it holds the article or more than half of the text-to-tag mass of the page."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int, bool]] = []  # tag, innermost container, furniture from here on
        self.opened: Counter[str] = Counter()  # open elements of each kind
        self.lines: list[tuple[str, int, int, int, bool, int]] = []
        self.parent = [0]  # of each container, numbered in page order from 1; 0 is the page
        self.regions: dict[int, str] = {}
        self.forms: set[int] = set()
        self.parts: list[str] = []
        self.tags = self.links = self.anchors = 0

    def end_line(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text or self.tags:
            _, container, furniture = self.open[-1] if self.open else ("", 0, False)
            self.lines.append((text, max(self.tags, 1), self.links, container, furniture, self.anchors))
        self.parts, self.tags, self.links, self.anchors = [], 0, 0, 0

    def inside(self) -> bool:
        return any(self.opened[tag] for tag in REGIONS)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        block = tag not in INLINE
        if block:
            self.end_line()
        self.tags += 1
        self.anchors += tag == "a"
        if tag in VOID:
            return
        if tag in IMPLIED_END:
            self.end(tag, within=("ul", "ol", "dl", "table", "div", "article", "section"))
        if tag in REGIONS:  # an unclosed menu or header does not swallow the article
            while self.open and self.open[-1][0] in ("nav", "header", "ul", "li", "a", "p"):
                self.close_from(len(self.open) - 1)
        _, container, bad = self.open[-1] if self.open else ("", 0, False)
        inside = self.inside()
        bad = bad or (tag in FURNITURE and tag != "form" and not (inside and tag in CONTROLS)) or (
            tag == "header" and not inside) or (
            tag not in ("html", "body") and names_furniture(tag, attrs, inside))  # forms: see finish
        if tag in CONTAINERS:
            self.parent.append(container)
            container = len(self.parent) - 1
            if tag in REGIONS:
                self.regions[container] = tag
            elif tag == "form":
                self.forms.add(container)
        self.open.append((tag, container, bad))
        self.opened[tag] += 1

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag not in INLINE:
            self.end_line()
        self.tags += 1
        self.end(tag)

    def close_from(self, i: int) -> None:
        self.opened.subtract(tag for tag, _, _ in self.open[i:])
        del self.open[i:]

    def end(self, tag: str, within: tuple[str, ...] = ()) -> None:
        if not self.opened[tag]:
            return
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                self.close_from(i)
                return
            if self.open[i][0] in within:
                return

    def sums(self, values) -> list:
        """For every container the sum over its lines, those of containers in it included; ``values`` by line."""
        out = [0] * len(self.parent)
        for line, value in zip(self.lines, values, strict=True):
            out[line[3]] += value
        for n in range(len(out) - 1, 0, -1):  # a container's number is above its parent's
            out[self.parent[n]] += out[n]
        return out

    def below(self, containers) -> list[bool]:
        """For every container whether it is one of ``containers`` or in one."""
        out = [n in containers for n in range(len(self.parent))]
        for n in range(1, len(out)):
            out[n] = out[n] or out[self.parent[n]]
        return out

    def above(self, containers) -> list[bool]:
        """For every container whether one of ``containers`` is in it."""
        out = [False] * len(self.parent)
        for n in range(len(out) - 1, 0, -1):
            out[self.parent[n]] = out[self.parent[n]] or out[n] or n in containers
        return out

    def finish(self) -> None:
        super().close()
        self.end_line()
        if not self.forms:
            return
        mass = self.sums(0.0 if bad else max(len(text) - links, 0) / tags for text, tags, links, _, bad, _ in self.lines)
        framing = self.above(self.regions)
        inner = self.below({n for n in self.forms if not framing[n] and mass[n] <= mass[0] / 2})
        self.lines = [(*line[:4], line[4] or inner[line[3]], line[5]) for line in self.lines]

    def handle_data(self, data: str) -> None:
        if self.open and self.open[-1][0] in NO_TEXT and not (self.open[-1][0] in CONTROLS and self.inside()):
            return
        self.parts.append(data)
        if self.opened["a"]:
            self.links += letters(data)


def smoothed_ratios(lines: list, sigma: float) -> np.ndarray:
    """Text-to-tag ratio of each line, smoothed along the page."""
    raw = np.array([0.0 if bad else max(len(text) - links, 0) / tags for text, tags, links, _, bad, _ in lines])
    reach = max(1, int(round(3 * sigma)))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(raw)), kernel)[reach:reach + len(raw)]
    return np.convolve(raw, kernel)[reach:reach + len(raw)] / weight


def content_lines(ratios: np.ndarray) -> np.ndarray:
    """True for the lines of the upper of two clusters of the log ratios."""
    x = np.log1p(ratios)
    lo, hi = x.min(), x.max()
    if hi <= 0:
        return np.zeros(len(x), bool)
    for _ in range(50):
        split = (lo + hi) / 2
        upper = x >= split
        if not upper.any():  # ratios that differ by rounding alone
            break
        new = (x[~upper].mean() if (~upper).any() else lo, x[upper].mean())
        if new == (lo, hi):
            break
        lo, hi = new
    return x >= min((lo + hi) / 2, x.max())


#: Share of the marked text that a container has to hold to be the region.
REGION_SHARE = 0.7


def extract(html: str | None, sigma: float = 1.0, region_share: float = REGION_SHARE) -> str:
    """The main text of one page, its blocks in page order joined by one space."""
    if not html:
        return ""
    page = Lines()
    page.feed(html)
    page.finish()
    lines = page.lines
    if not any(text for text, *_ in lines):
        return ""
    marked = content_lines(smoothed_ratios(lines, sigma))
    own = [max(len(text) - links, 0) if up and not bad else 0
           for (text, _, links, _, bad, _), up in zip(lines, marked, strict=True)]
    weights = page.sums(own)
    total = weights[0]
    kept = [i for i, line in enumerate(lines) if line[0] and not line[4]]
    regions = {n for n in page.regions if weights[n] > 0}
    within = {n for n in regions if page.regions[n] == "main"}  # where lines beside the articles are looked for
    articles = regions - within
    in_articles = page.below(articles)
    if articles and sum(w for w, line in zip(own, lines, strict=True) if in_articles[line[3]]) >= region_share * total:
        regions = articles
    elif not within:  # articles without most of the text are teasers
        narrow = [n for n, w in enumerate(weights) if n and w >= region_share * total] if total else []
        regions, within = {max(narrow)} if narrow else set(), None  # numbered in page order: the largest is the deepest
    if regions:
        inside = joined(page, marked, regions, within, region_share)
        kept = [i for i in kept if i in inside]
    in_named = page.below({n for n in regions if n in page.regions})
    # a line of links is a menu beside an article; in it, an entry of its references
    kept = [i for i in kept if in_named[lines[i][3]] or not menu_like(lines[i])]
    return " ".join(lines[i][0] for i in kept)


def joined(page: Lines, marked: np.ndarray, regions: set[int], within: set[int] | None, share: float) -> set[int]:
    """The lines of ``regions`` and of the containers that other marked lines stand in; if ``within`` is given, of
    those lines only that stand in one of these containers.

    Such a line brings the widest container that lies beside the regions and whose text is marked for the most
    part; if its container is around a region, the lines that stand in just that container."""
    lines, parent = page.lines, page.parent
    in_regions, in_within = page.below(regions), page.below(within or set())
    around = page.above({n for n in regions if not in_regions[parent[n]]})
    around[0] = True
    text = page.sums(0 if line[4] else len(line[0]) for line in lines)
    up_text = page.sums(0 if line[4] or not up else len(line[0]) for line, up in zip(lines, marked, strict=True))
    widest, found = list(range(len(parent))), [False] * len(parent)  # the container that a line of each brings
    for n in range(1, len(parent)):
        if around[n]:
            continue
        if found[parent[n]]:
            widest[n], found[n] = widest[parent[n]], True
        else:
            found[n] = up_text[n] >= share * text[n]
    whole, own = set(regions), set()
    for (words, _, links, container, bad, _), up in zip(lines, marked, strict=True):
        if bad or not up or len(words) <= links or in_regions[container] or (within is not None and not in_within[container]):
            continue
        (own if around[container] else whole).add(container if around[container] else widest[container])
    in_whole = page.below(whole)
    return {i for i, line in enumerate(lines) if line[3] in own or in_whole[line[3]]}


def menu_like(line: tuple) -> bool:
    """A line that is nothing but several links."""
    text, _, links, _, _, anchors = line
    return anchors >= 2 and links >= 0.9 * letters(text)


def main_text(pages: DataFrame, html: str = "html", out: str = "text", sigma: float = 1.0) -> DataFrame:
    """``pages`` with the column ``out``: the main text of each page, never null."""
    bounded_batches(pages.sparkSession)

    @F.arrow_udf("string")
    def run(column: pa.Array) -> pa.Array:
        return pa.array([extract(x, sigma) for x in column.to_pylist()], pa.string())

    return pages.withColumn(out, run(F.col(html)))
