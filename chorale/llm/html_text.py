"""Main text of web pages by text-to-tag ratios.

The standard library's parser streams a page as events; block elements cut it into lines,
each with its text, the tags inside it and the elements it lies in. The ratio of text to
tags of each line is smoothed by a Gaussian, and a two-cluster threshold over the smoothed
ratios tells content lines. They choose the region: the articles that hold content lines,
else the ``main`` that does, else the stretch from the first content line to the last. An
article or main so chosen gives all its lines, since its first and last ones are short.

Menus, forms, adverts, comments and the like never count. A form, and an element that only
its class or id speaks against, is judged by the content lines too: a name (or ``form``)
that holds most of the content of a page is part of its layout there and hides nothing.
"""

from __future__ import annotations

import math
import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from chorale.llm.common import per_batch, prepared, text_column

FEED = 1 << 16  # characters given to the parser at a time
APART = 1.0  # least distance of the logarithms of two clusters of ratios
SPREAD = 1.5  # standard deviation of the smoothing, in lines
LAYOUT = 0.75  # share of the content text from which on a name is one of the layout

BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol option p pre section select summary "
    "table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
LEFT_OUT = frozenset(
    "applet aside audio button canvas datalist dialog embed footer frame frameset head header iframe input label map "
    "legend menu meter nav noframes noscript object option progress script search select style svg template textarea title video".split()
)
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog menu menubar navigation search".split())
NAMES = frozenset(
    "ad ads adsense advert advertisement advertisements adverts adslot banner banners breadcrumb breadcrumbs comment comments commentlist "
    "consent cookie cookies dialog disqus disclaimer footer gdpr header masthead menu menus modal nav navbar navigation newsletter notice "
    "notices notification overlay pagination pager popup promo promotion related reply replies respond share sharing "
    "sidebar signup skyscraper social sponsor sponsored subscribe toolbar topbar widget widgets".split()
)
COMMENTS = frozenset("comment comments commentlist disqus replies reply respond".split())
# Such ends of a name tell how a page is laid out, not what an element is: no-sidebar, comments-open.
BEFORE = frozenset("has no with without".split())
AFTER = frozenset("closed disabled enabled open".split())
WRAPS = frozenset("wrap wrapper".split())
_SPLIT = re.compile(r"[^a-z0-9]+")
# Elements that an end tag of something opened before them does not close, and the end tags that may.
HOLDS = frozenset("article body html main td th".split())
ENDS = frozenset("article body html main table".split())
_MARKUP = re.compile(r"<[A-Za-z/!?]")


def named(token: str) -> set[str]:
    """The names that a class or id begins or ends with."""
    parts = [x for x in _SPLIT.split(token) if x]
    if not parts or parts[0] in BEFORE or parts[-1] in AFTER:
        return set()
    if parts[-1] in WRAPS:
        # A wrap is left out by a name only if it wraps nothing else: ad-wrap, but not content-sidebar-wrap.
        return set(parts[:-1]) if NAMES.issuperset(parts[:-1]) else set()
    return NAMES.intersection((parts[0], parts[-1]))


def unwanted(tag: str, attributes: list[tuple[str, str | None]]) -> set[str] | None:
    """The names that speak against an element; None for one that by its kind or role is no article text."""
    if tag in LEFT_OUT:
        return None
    names = {"form"} if tag == "form" else set()
    if tag in ("html", "body", "article", "main"):
        return names
    for name, value in attributes:
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return None
        if not value:
            continue
        if name == "role":
            if value.lower() in ROLES:
                return None
            if value.lower() == "form":
                names.add("form")
        if name in ("class", "id"):
            names.update(*map(named, value.lower().split()))
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return None
    return names if COMMENTS.isdisjoint(names) else None


class Lines(HTMLParser):
    """Lines of a page outside unwanted elements: pieces of text with the names they lie under, number of tags, article or main."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        # Open elements with the state outside each, and where those of a kind are among them.
        self.open: list[tuple[str, int, frozenset[str] | None]] = []
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.holds: list[int] = []
        self.region = 0
        self.names: frozenset[str] | None = frozenset()  # None in an element that is left out
        self.regions: list[str] = ["page"]
        self.parts: list[tuple[str, frozenset[str]]] = []
        self.tags = 0
        self.lines: list[tuple[list[tuple[str, frozenset[str]]], int, int]] = []

    def cut(self) -> None:
        # Tags without text count to the line that follows.
        if any(not text.isspace() for text, _ in self.parts):
            self.lines.append((self.parts, self.tags, self.region))
            self.tags = 0
        self.parts = []

    def handle_starttag(self, tag, attrs) -> None:
        if tag in BLOCKS:
            self.cut()
            # A block ends an open paragraph and what is open inside it.
            if self.blocks and self.open[self.blocks[-1]][0] == "p":
                self._close(self.blocks[-1])
        self.tags += 1
        if tag in VOID:
            return
        at = len(self.open)
        self.open.append((tag, self.region, self.names))
        self.places.setdefault(tag, []).append(at)
        if tag in BLOCKS:
            self.blocks.append(at)
        if tag in HOLDS:
            self.holds.append(at)
        if self.names is None:
            return
        # An article is read whatever its wrappers are called; inside another one, as a related story, it is not.
        if tag in ("article", "main") and (not self.names or self.regions[self.region] != "article"):
            self.regions.append(tag)
            self.region, self.names = len(self.regions) - 1, self.names & {"form"}
        found = unwanted(tag, attrs)
        self.names = None if found is None else self.names | found if found else self.names

    def handle_startendtag(self, tag, attrs) -> None:
        if tag in BLOCKS:
            self.cut()
        self.tags += 1

    def _close(self, k: int) -> None:
        """Close the open elements from the k-th on; each is closed once."""
        _, self.region, self.names = self.open[k]
        while len(self.open) > k:
            tag = self.open.pop()[0]
            self.places[tag].pop()
            if tag in BLOCKS:
                self.blocks.pop()
            if tag in HOLDS:
                self.holds.pop()

    def handle_endtag(self, tag) -> None:
        if tag in BLOCKS:
            self.cut()
        self.tags += 1
        places = self.places.get(tag)
        if places and (tag in ENDS or not self.holds or self.holds[-1] <= places[-1]):
            self._close(places[-1])

    def handle_data(self, data) -> None:
        if self.names is not None:
            self.parts.append((data, self.names))

    def close(self) -> None:
        # A tag or comment that never ends is no text.
        if _MARKUP.match(self.rawdata):
            self.rawdata = ""
        super().close()
        self.cut()


def smoothed(ratios: np.ndarray, spread: float = SPREAD) -> np.ndarray:
    reach = max(1, math.ceil(3 * spread))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / spread) ** 2)
    return np.convolve(np.pad(ratios, reach, mode="edge"), kernel / kernel.sum(), "valid")


def threshold(values: np.ndarray) -> float:
    """Half-way between the centres of two clusters of the values (their logarithms).

    Values that do not fall apart, with centres less than APART from each other, are all
    content: 0.
    """
    x = np.log1p(values)
    low, high = float(x.min()), float(x.max())
    for _ in range(30):
        upper = x > (low + high) / 2
        if not upper.any() or upper.all():
            break
        new = float(x[~upper].mean()), float(x[upper].mean())
        if new == (low, high):
            break
        low, high = new
    return float(np.expm1((low + high) / 2)) if high - low >= APART else 0.0


def spaced(parts) -> str:
    """The text of pieces, white space as one space."""
    return " ".join("".join(parts).split())


def hiding(lines: list, lengths: np.ndarray, content: np.ndarray) -> set[str]:
    """The names that hide what lies under them: not those that hold most of the content text."""
    held: dict[str, int] = {}
    for k in np.flatnonzero(content).tolist():
        for text, names in lines[k][0]:
            for name in names:
                held[name] = held.get(name, 0) + len(text)
    least = LAYOUT * lengths[content].sum()
    every = {name for parts, *_ in lines for _, names in parts for name in names}
    return {name for name in every if held.get(name, 0) < least}


def main_text(html: str) -> str:
    """The article of a page, white space in each block as one space, blocks joined by one space."""
    parser, at = Lines(), 0
    while at < len(html):
        # What the parser holds back is looked at again, so the next piece is as long.
        step = max(FEED, len(parser.rawdata))
        parser.feed(html[at : at + step])
        at += step
    parser.close()
    lines = parser.lines
    if not lines:
        return ""
    lengths = np.array([sum(len(text) for text, _ in parts) for parts, *_ in lines])
    smooth = smoothed(np.array([len(spaced(x for x, _ in parts)) / max(1, tags) for parts, tags, _ in lines]))
    content = smooth >= threshold(smooth)
    hides = hiding(lines, lengths, content)
    texts = [spaced(x for x, names in parts if hides.isdisjoint(names)) for parts, *_ in lines]
    visible = np.array([bool(t) for t in texts])
    if not visible.any():
        return ""
    # A page whose content is hidden has what is left of it.
    chosen = content & visible if (content & visible).any() else visible
    region = np.array([r for *_, r in lines])
    for kind in ("article", "main"):
        held = [r for r in np.unique(region[chosen]).tolist() if parser.regions[r] == kind]
        if held:
            return " ".join(texts[k] for k in np.flatnonzero(visible & np.isin(region, held)))
    # Lines between content lines belong to the same region.
    first, last = np.flatnonzero(chosen)[[0, -1]]
    return " ".join(texts[k] for k in range(first, last + 1) if visible[k])


def _work(batch: pa.RecordBatch) -> pa.RecordBatch:
    texts = [main_text(x) for x in text_column(batch, "html").to_pylist()]
    return pa.RecordBatch.from_arrays(
        [batch.column("page_id"), batch.column("url"), pa.array(texts), pa.array([len(t) for t in texts], pa.int64())],
        names=["page_id", "url", "text", "n_chars"],
    )


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page.

    A null, empty or textless page has an empty text. Repeated rows are worked each. An end
    tag that nothing opened is passed over, and markup that never ends is dropped; the time
    follows the length of a page, whatever its markup. Pages are parsed where they are read,
    without a shuffle; other columns are not read. An empty table gives no rows.
    """
    prepared(pages.sparkSession)
    kinds = ", ".join(f"{c} {pages.schema[c].dataType.simpleString()}" for c in ("page_id", "url"))
    return pages.select("page_id", "url", "html").mapInArrow(per_batch(_work), f"{kinds}, text string, n_chars bigint")
