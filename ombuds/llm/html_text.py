"""Main text of web pages from the text-to-tag ratios of their lines.

The standard library's parser streams a page's events. Blocks of text between block-level tags are its lines; each has
a ratio of characters to tags. The ratios are smoothed with a Gaussian along the page, and lines above a threshold
form the content clusters. The clusters select the regions of the page that are content: an element such as
``article`` or ``div`` whose lines are mostly in a cluster is taken with all its lines, so that a short paragraph
between long ones stays. An ``article`` or ``main`` is taken so with the regions inside it, up to the next article, and
decides nothing about what stands outside. The only article of a page is always taken. What the markup itself declares to be no content (menus, forms, adverts, comments of readers
and the like) is never selected, though its lines count in the smoothing.
"""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ombuds.llm.common import ready, with_columns

SIGMA, REACH = 1.0, 3
#: Of the standard deviation of the smoothed ratios.
THRESHOLD = 0.5

BLOCK = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td"
    " tfoot th thead title tr ul".split()
)
REGION = set("article aside body details dialog div figure footer form header main nav section table td".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Text that is never shown, or belongs to controls.
UNSEEN = set("script style noscript template title svg math iframe object canvas button select textarea datalist audio video".split())
APART = set("nav aside footer form dialog menu".split())
#: Words in a class, an id or a role that mark a region as no content.
MARKS = set(
    "ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs byline complementary consent"
    " contentinfo cookie cookies dialog disclaimer footer form gdpr legal login masthead menu modal nav navbar"
    " navigation newsletter notice notification pager pagination popup promo promoted promotion recommended related"
    " search share sharing sidebar signup skip social sponsor sponsored subscribe subscription teaser toolbar widget".split()
)
TALK = set("comment comments commentlist discussion disqus replies reply respond responses".split())
#: Inside an article only these tell by themselves; other words may be its subject, and the ratio or the links decide.
SURE = set(
    "ad ads advert advertisement advertising adverts breadcrumb breadcrumbs complementary consent contentinfo cookie cookies"
    " gdpr masthead navbar pager pagination promo promoted sponsored toolbar".split()
) | {"comments", "commentlist", "disqus"}
#: A class made of one of these, and of words for places on a page, is no subject either, if it is of a part of a page.
SOLE = set(
    "banner comment disclaimer disclaimers newsletter notice notices notification notifications popup recommended related"
    " replies reply share sharing sidebar signup social sponsor sponsors subscribe subscription".split()
)
PLACES = set(
    "area bar block box buttons card container footer inner item items left links list outer panel posts right section site"
    " stories top wrap wrapper".split()
)
PARTS = set("article details div dl li ol section ul".split())
ROLES = set("form menu menubar navigation search toolbar".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
#: Stands for an article's own heading where it is inside one.
HEADING = {"header", "heading", "headline"}


def _marks(attrs: list[tuple[str, str | None]], names: tuple[str, ...] = ("class", "id", "role")) -> set[str]:
    text = " ".join(value for name, value in attrs if name in names and value)
    return set(re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", text).lower())) if text else set()


@dataclass(slots=True)
class Line:
    text: str
    tags: int
    region: int
    apart: bool
    linked: int  # characters inside links
    doubt: int  # the nearest marked element around it that the ratio or the links decide on, or -1


@dataclass(slots=True)
class Open:
    tag: str
    region: int
    apart: str  # why the element is no content: "", "mark", "unseen" or "talk"
    doubt: int = -1


def _alone(attrs: list[tuple[str, str | None]]) -> bool:
    """Whether a class says by itself that a part is no content: ``social`` or ``social-links``, not ``social-history``."""
    names = " ".join(value for name, value in attrs if name == "class" and value)
    for token in names.split():
        words = set(re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", token).lower()))
        if words & SOLE and words <= SOLE | PLACES | SURE:
            return True
    return False


class Lines(HTMLParser):
    """The lines of a page, and the parent of each of its regions."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.parents = [-1]
        self.kinds = [""]
        self.open = [Open("", 0, "")]
        #: Where in ``open`` each tag, the last region or list, and the last block stand, so that nothing is searched.
        self.places: dict[str, list[int]] = defaultdict(list)
        self.walls: list[int] = []
        self.blocks: list[int] = []
        self.doubts: list[int] = []  # the doubt around each
        self.pieces: list[str] = []
        self.tags = self.linked = 0
        self.seen_article = False

    def flush(self) -> None:
        text = " ".join("".join(self.pieces).split())
        if text:
            top = self.open[-1]
            self.lines.append(Line(text, self.tags, top.region, bool(top.apart), self.linked, top.doubt))
            self.tags = 0
        self.pieces, self.linked = [], 0

    def inside_article(self) -> bool:
        return bool(self.places["article"] or self.places["main"])

    def why_apart(self, tag: str, attrs: list[tuple[str, str | None]]) -> str:
        if tag in UNSEEN:
            return "unseen"
        if tag in ("html", "body"):
            return ""
        marks = _marks(attrs)
        if self.inside_article():
            return self.why_apart_inside(tag, attrs)
        if marks & TALK:
            return "talk"
        if any(name == "hidden" or (name == "aria-hidden" and value == "true") for name, value in attrs):
            return "mark"
        within = tag in ("article", "main")
        if tag in APART or (tag == "header" and not within):
            return "mark"
        if tag in BLOCK or tag in ("span", "a", "b", "i", "em", "strong", "small", "ins"):
            if marks & MARKS and not (within and marks & HEADING and not marks & MARKS - {"banner"}):
                return "mark"
            if "header" in marks and not within and tag in REGION:
                return "mark"
        return ""

    def why_apart_inside(self, tag: str, attrs: list[tuple[str, str | None]]) -> str:
        """The same within an article; "doubt" where a mark may be the article's subject."""
        if any(name == "hidden" or (name == "aria-hidden" and value == "true") for name, value in attrs):
            return "mark"
        if tag in APART:
            return "mark"
        if tag in HEADINGS or tag == "p":
            return ""
        said = _marks(attrs, ("class", "role"))
        # Ids are often made from headings, but for those of a div.
        sure = said | _marks(attrs, ("id",)) if tag == "div" else said
        if sure & TALK & SURE:
            return "talk"
        if tag not in BLOCK and tag not in ("span", "a", "b", "i", "em", "strong", "small", "ins"):
            return ""
        if sure & SURE or (tag in PARTS and _alone(attrs)) or _marks(attrs, ("role",)) & ROLES:
            return "mark"
        titled = said & HEADING and not said & MARKS - {"banner"}
        return "doubt" if tag in BLOCK and said & (MARKS | TALK) and not titled else ""

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        if tag in BLOCK:
            self.flush()
        elif tag == "br":
            self.pieces.append(" ")
        if tag in VOID:
            return
        if tag == "p" or tag == "li":
            self.close_open(tag, until=self.walls)
        why = self.why_apart(tag, attrs)
        if tag in ("article", "main") and not why and self.open[-1].apart == "mark" and not self.seen_article:
            # The page's article begins, so what was open before it had lost its end tag.
            while self.open[-1].apart:
                self.cut(len(self.open) - 1)
        top = self.open[-1]
        region = top.region
        if tag in REGION:
            region = len(self.parents)
            self.parents.append(top.region)
            self.kinds.append(tag)
        self.seen_article = self.seen_article or tag in ("article", "main")
        doubt = top.doubt
        if why == "doubt":
            self.doubts.append(doubt)
            why, doubt = "", len(self.doubts) - 1
        here = len(self.open)
        self.places[tag].append(here)
        if tag in REGION or tag in ("ul", "ol"):
            self.walls.append(here)
        if tag in BLOCK:
            self.blocks.append(here)
        self.open.append(Open(tag, region, top.apart or why, doubt))

    def cut(self, place: int) -> None:
        """Close the open elements from ``place`` on."""
        for gone in self.open[place:]:
            self.places[gone.tag].pop()
        del self.open[place:]
        for stack in (self.walls, self.blocks):
            while stack and stack[-1] >= place:
                stack.pop()

    def close_open(self, tag: str, until: list[int]) -> None:
        """Close the last open ``tag`` and what is inside it, unless the last of ``until`` is inside it too."""
        found = self.places[tag]
        if found and (not until or found[-1] >= until[-1]):
            self.cut(found[-1])

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in BLOCK:
            self.flush()
        # An end tag of inline markup never closes a block around it.
        self.close_open(tag, until=[] if tag in BLOCK else self.blocks)

    def handle_data(self, data: str) -> None:
        if self.open[-1].apart != "unseen":
            self.pieces.append(data)
            if self.places["a"]:
                self.linked += len(data)


def smoothed(ratios: np.ndarray) -> np.ndarray:
    """The ratios averaged along the page with Gaussian weights; beyond its ends nothing counts."""
    offsets = np.arange(-REACH, REACH + 1)
    weights = np.exp(-(offsets**2) / (2 * SIGMA**2))
    total = np.convolve(ratios, weights, "same") if len(ratios) >= len(weights) else _short(ratios, weights)
    share = np.ones(len(ratios))
    share = np.convolve(share, weights, "same") if len(ratios) >= len(weights) else _short(share, weights)
    return total / share


def _short(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return np.convolve(values, weights, "full")[REACH : REACH + len(values)]


def main_text(html: str | None) -> str:
    """The content lines of a page, joined by spaces in the page's order."""
    page = Lines()
    page.feed(html or "")
    page.close()
    page.flush()
    lines = page.lines
    if not any(not line.apart for line in lines):
        return ""
    ratios = np.array([len(line.text) / max(1, line.tags) for line in lines])
    even = smoothed(ratios)
    # A marked element inside an article goes if it has little text for its tags, or mostly links.
    size, tags, links = ([0] * len(page.doubts) for _ in range(3))
    for line in lines:
        if line.doubt >= 0:
            size[line.doubt] += len(line.text)
            tags[line.doubt] += line.tags
            links[line.doubt] += line.linked
    for inner in range(len(page.doubts) - 1, -1, -1):  # what is inside counts outside as well
        outer = page.doubts[inner]
        if outer >= 0:
            size[outer], tags[outer], links[outer] = size[outer] + size[inner], tags[outer] + tags[inner], links[outer] + links[inner]
    bar = THRESHOLD * even.std()
    none: list[bool] = []
    for x, outer in enumerate(page.doubts):
        empty = 2 * links[x] > size[x] or (size[x] > 0 and size[x] / max(1, tags[x]) < bar)
        none.append(empty or (outer >= 0 and none[outer]))
    for line in lines:
        line.apart = line.apart or (line.doubt >= 0 and none[line.doubt])
    if all(line.apart for line in lines):
        return ""
    # A line that is mostly links may stay beside text, but doesn't make a region content.
    free = np.array([not line.apart and 2 * line.linked <= len(line.text) for line in lines])
    if not free.any():
        free = np.array([not line.apart for line in lines])
    cluster = (even >= bar) & free
    if not cluster.any():
        cluster = free & (even >= even[free].max())
    inside, chosen = defaultdict(int), defaultdict(int)
    for line, taken in zip(lines, cluster, strict=True):
        if not line.apart:
            inside[line.region] += len(line.text)
            chosen[line.region] += len(line.text) * bool(taken)
    regions = {region for region in inside if 2 * chosen[region] >= inside[region] and chosen[region]}

    # The nearest article around each region, or -1. Regions come after those around them.
    article = [-1]
    for region in range(1, len(page.parents)):
        own = page.kinds[region] in ("article", "main")
        article.append(region if own else article[page.parents[region]])

    # An article that is mostly in a cluster is filled: its short regions stay beside the long ones.
    text, taken = defaultdict(int), defaultdict(int)
    for region in inside:
        text[article[region]] += inside[region]
        taken[article[region]] += chosen[region]
    full = {x for x in text if x >= 0 and 2 * taken[x] >= text[x] and taken[x]}
    for kind in ("article", "main"):
        only = [x for x in text if x >= 0 and page.kinds[x] == kind]
        if only:
            full |= set(only) if len(only) == 1 else set()
            break
    regions |= {r for r in inside if article[r] in full}
    return " ".join(line.text for line in lines if not line.apart and line.region in regions)


def extract(pages: DataFrame, html: str = "html", text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """``pages`` with the main text of each whole page and its number of code points.

    Null and empty pages, and pages without content, give the empty text. Pages of any length are parsed whole, by
    streaming events. Each row stands for itself, so ties and repeated rows are kept, and an empty table stays empty.
    Columns named as the new ones are replaced, all others stay.
    """
    ready(pages.sparkSession)
    added = [T.StructField(text, T.StringType(), True), T.StructField(n_chars, T.LongType(), True)]

    def both(values: list[str | None]) -> list[pa.Array]:
        found = [main_text(value) for value in values]
        return [pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())]

    return with_columns(pages, html, added, lambda: both)
