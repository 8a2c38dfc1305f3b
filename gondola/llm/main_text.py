"""The main text of web pages, from flat text blocks.

A page is cut into blocks of text at block-level tags. Each block is described by its word count and link
density, those of the blocks before and after it, the run of link blocks it is in, and how surely what encloses it is
no article; a decision tree, trained on the small labelled table below, tells article text from the rest. Where a box
is surely outside (nav, class "comments") the tree asks nothing else; names that only hint at that are one input of several.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TAG = re.compile(r"<(/?)([A-Za-z][A-Za-z0-9:_-]*+)")
OPENS = re.compile(r"<[A-Za-z/!]")
GAP = re.compile(r"[\s/]*+")
NAME = re.compile(r"[^\s/>=<]++|[=<]")
EQUALS = re.compile(r"\s*+=\s*+")
BARE = re.compile(r"[^\s<>]*+")
UNCLOSED = re.compile(r"[^<>]*+")
NO_DISPLAY = re.compile(r"display\s*:\s*none")
PARTS_OF_NAMES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
# Fixed values of HTML.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section "
    "summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title template noscript iframe".split())  # markup inside is not read
RAW_TO_THE_END = frozenset("script style".split())  # of the page, if nothing ends them
DROPPED = frozenset("button select svg canvas audio video object annotation annotation-xml".split())
LEAVES = frozenset("button select svg".split())  # that end at one of ENDS_LEAVES
ENDS_LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 article section main ul ol table blockquote".split())
CLOSE_P = BLOCKS - frozenset("body caption dd dt head html legend li option optgroup tbody td tfoot th thead tr title".split())
CELLS = frozenset("table td th".split())
LISTS = frozenset("ul ol dl table menu select".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
OUTSIDE_TAGS = frozenset("nav header footer aside form menu dialog".split())
OUTSIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
INSIDE_TAGS = frozenset("article main".split())
# Words of class names and ids. Those of OUTSIDE_NAMES tell a box that is no article, those of HINTS only if nothing but
# FRAMES and other such words are in the name: "related-posts", but not "related-work".
OUTSIDE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising breadcrumb breadcrumbs comment comments consent cookies copyright "
    "disclaimer disqus footer gdpr login masthead nav navbar navigation newsletter pager pagination popup promo promoted "
    "promotion replies respond sidebar signup sponsor sponsored subscribe subscription toolbar topbar".split()
)
HINTS = frozenset("banner cookie header legal menu modal notice recommended related reply search share sharing skip social widget widgets".split())
FRAMES = frozenset(
    "area articles bar block body bottom box button buttons card cards col column container content dropdown field fixed "
    "group icons inner input item items left link links list main mobile module nav outer overlay page pages panel post posts "
    "primary reader right row secondary section site slot stories sticky story tab text toggle top user wrap wrapper".split()
)
INSIDE_NAMES = frozenset("article entry post story content main".split())
NEVER_INSIDE = frozenset("ad ads comment comments menu nav navigation related sidebar".split())
NEGATIONS = frozenset("has hide is no not show with without".split())

FEATURES = (
    "words", "links", "words_before", "links_before", "words_after", "links_after", "linked_run", "outside", "inside",
    "page_has_inside", "heading",
)
LINKED = 8  # tenths of a block's words, from which it belongs to a run of links
#: Labelled blocks: FEATURES (shares of linked words in tenths; linked_run: blocks of links in a row, this one with them; outside:
#: 0, 1 perhaps, 2 surely), then 1 for main text. Judged by hand from page layouts.
LABELLED = """
5 10 0 0 5 10 3 2 0 1 0 0
1 10 1 10 1 10 5 2 0 1 0 0
1 10 1 10 8 0 3 2 0 1 0 0
3 10 0 0 3 10 3 2 0 0 0 0
2 10 2 10 40 0 3 2 0 0 0 0
12 0 1 10 9 0 0 2 0 1 0 0
24 0 1 10 9 0 0 2 0 1 0 0
60 0 2 10 11 0 0 2 0 1 0 0
9 0 120 0 0 0 0 2 0 1 0 0
30 1 80 0 0 0 0 2 0 1 0 0
14 0 1 0 0 0 0 2 0 1 0 0
45 0 30 0 30 0 0 2 0 0 0 0
55 0 60 0 40 0 0 2 1 1 0 0
18 0 70 0 12 0 0 2 1 1 0 0
4 0 50 0 20 0 0 2 1 1 1 0
8 10 90 0 6 10 3 2 1 1 0 0
6 0 4 10 50 0 0 2 0 0 1 0
7 3 40 0 6 3 0 2 1 1 0 0
2 0 35 0 26 0 0 2 0 1 1 0
90 0 12 0 14 0 0 2 0 1 0 0
9 0 12 0 80 0 0 0 1 1 1 1
11 0 9 0 1 0 0 0 1 1 1 1
1 0 10 0 60 0 0 0 1 1 0 1
1 0 60 0 1 0 0 0 1 1 0 1
2 0 1 0 2 0 0 0 1 1 0 1
80 0 9 0 40 0 0 0 1 1 0 1
140 0 80 0 9 0 0 0 1 1 0 1
35 1 60 0 50 0 0 0 1 1 0 1
40 3 25 0 45 0 0 0 1 1 0 1
6 0 40 0 45 0 0 0 1 1 1 1
3 0 45 0 12 0 0 0 1 1 1 1
12 5 40 0 40 0 0 0 1 1 0 1
4 10 40 0 60 0 1 0 1 1 0 1
8 10 30 0 50 2 1 0 1 1 0 1
5 0 5 0 5 0 0 0 1 1 0 1
300 0 0 0 0 0 0 0 1 1 0 1
1 0 0 0 0 0 0 0 1 1 0 1
7 0 0 0 0 0 0 0 1 1 1 1
25 0 5 10 3 10 0 0 1 1 0 1
1 0 40 0 1 10 0 0 1 1 0 1
5 0 60 0 2 10 0 0 1 1 0 1
12 0 30 0 4 10 0 0 1 1 0 1
20 0 90 0 1 10 0 0 1 1 0 1
8 0 0 0 1 10 0 0 1 1 1 1
60 0 12 0 6 10 0 0 1 1 0 1
3 0 30 0 7 8 0 0 1 1 0 1
2 10 30 0 4 10 2 0 1 1 0 1
9 0 10 10 200 0 0 0 1 1 1 1
4 10 4 10 5 10 5 0 0 1 0 0
20 0 1 10 8 0 0 0 0 1 0 0
8 0 40 0 0 0 0 0 0 1 0 0
50 0 4 10 12 0 0 0 0 1 0 0
6 0 0 0 3 10 0 0 0 1 1 0
15 2 60 0 20 0 0 0 0 1 0 0
120 0 6 0 9 0 0 0 0 1 0 0
2 0 70 0 2 10 0 0 0 1 0 0
70 0 6 0 60 0 0 0 0 0 0 1
30 0 60 0 45 0 0 0 0 0 0 1
22 1 35 0 30 0 0 0 0 0 0 1
16 0 40 0 5 0 0 0 0 0 0 1
48 2 10 0 3 10 0 0 0 0 0 1
90 0 0 0 0 0 0 0 0 0 0 1
7 0 3 10 60 0 0 0 0 0 1 1
5 0 60 0 45 0 0 0 0 0 1 1
4 0 30 0 40 0 0 0 0 0 0 1
2 0 45 0 28 0 0 0 0 0 0 1
9 0 30 0 28 0 0 0 0 0 0 1
6 0 0 0 0 0 0 0 0 0 0 1
3 10 3 10 3 10 5 0 0 0 0 0
2 10 0 0 2 10 3 0 0 0 0 0
1 10 1 10 60 0 3 0 0 0 0 0
14 8 12 9 10 8 5 0 0 0 0 0
20 9 50 0 4 10 3 0 0 0 0 0
10 6 8 10 3 10 0 0 0 0 0 0
4 0 2 10 2 10 0 0 0 0 0 0
5 0 3 10 4 8 0 0 0 0 0 0
7 5 60 0 5 10 0 0 0 0 0 0
24 0 60 0 4 10 0 0 0 0 0 1
9 0 70 0 30 0 0 0 0 0 0 1
1 0 60 0 50 0 0 0 0 0 0 1
2 0 1 10 2 10 0 0 0 0 0 0
3 0 2 10 1 10 0 0 0 0 1 0
60 0 8 0 40 0 0 1 1 1 0 1
35 0 50 0 30 0 0 1 1 1 0 1
120 1 3 0 60 0 0 1 1 1 0 1
2 0 60 0 50 0 0 1 1 1 1 1
4 0 30 0 70 0 0 1 1 1 1 1
1 0 20 0 30 0 0 1 1 1 0 1
6 0 0 0 40 0 0 1 1 1 0 1
9 2 40 0 0 0 0 1 1 1 0 1
8 0 3 10 45 0 0 1 1 1 1 1
5 10 2 0 6 10 3 1 1 1 0 0
6 10 5 10 7 10 5 1 1 1 0 0
4 9 6 10 30 0 3 1 1 1 0 0
9 10 60 0 0 0 1 1 1 1 0 0
3 10 40 0 50 0 1 1 1 1 0 0
2 0 60 0 5 10 0 1 1 1 1 0
3 0 0 0 6 10 0 1 1 1 1 0
12 6 8 10 9 10 0 1 1 1 0 0
30 5 50 0 5 10 0 1 1 1 0 0
50 0 4 10 40 0 0 1 0 1 0 0
4 10 3 10 5 10 5 1 0 1 0 0
80 0 6 0 60 0 0 1 0 0 0 1
30 0 40 0 50 0 0 1 0 0 0 1
5 0 60 0 45 0 0 1 0 0 1 1
4 10 3 10 5 10 5 1 0 0 0 0
3 0 2 10 4 10 0 1 0 0 1 0
90 0 60 0 80 0 0 2 1 1 0 0
70 0 90 0 0 0 0 2 0 0 0 0
120 0 40 0 60 0 0 2 0 1 0 0
3 10 40 0 4 10 3 0 1 1 0 0
5 10 3 10 2 10 5 0 1 1 0 0
7 10 60 0 9 10 4 0 1 1 0 0
2 9 5 10 80 0 6 0 1 1 0 0
12 10 12 10 11 10 9 0 1 1 0 0
4 10 30 0 6 10 2 0 1 1 0 1
6 10 4 10 50 0 2 0 1 1 0 1
3 0 50 0 12 0 0 1 1 1 0 1
1 0 9 0 3 0 0 1 1 1 0 1
40 0 80 0 0 0 0 1 1 1 0 1
12 0 60 0 0 0 0 1 1 1 0 1
15 0 120 0 8 0 0 1 1 1 0 1
2 0 2 0 2 0 0 1 1 1 0 1
5 0 0 0 0 0 0 1 1 1 0 1
8 0 100 0 20 0 0 1 1 1 0 1
4 0 70 0 60 0 0 1 1 1 0 1
3 0 60 0 20 0 0 1 1 1 1 1
40 0 5 10 4 10 0 1 1 1 0 1
25 1 60 0 1 10 0 1 1 1 0 1
9 0 12 0 80 0 0 1 1 1 1 1
10 5 60 0 50 0 0 1 1 1 0 1
2 0 5 10 6 10 0 1 1 1 0 0
4 0 80 0 7 10 0 1 1 1 1 0
2 10 30 0 3 10 2 1 1 1 0 0
60 0 50 0 70 0 0 0 0 1 0 0
25 0 12 0 90 0 0 0 0 1 0 0
5 0 20 0 120 0 0 0 0 1 0 0
7 0 30 0 45 0 0 0 0 1 1 0
110 0 80 0 30 0 0 0 0 1 0 0
14 0 4 0 60 1 0 0 0 1 0 0
40 2 60 0 120 0 0 0 0 1 0 0
9 1 2 0 26 0 0 0 0 1 0 0
60 0 50 0 70 0 0 1 0 1 0 0
12 0 20 0 44 0 0 1 0 1 0 0
6 0 0 0 80 0 0 1 0 1 1 0
30 0 3 0 5 0 0 1 0 1 0 0
40 0 60 0 8 0 0 1 0 0 0 1
70 0 4 10 50 0 0 1 0 0 0 1
10 0 45 0 30 0 0 1 0 0 0 1
3 0 40 0 30 0 0 1 0 0 0 1
2 10 3 0 60 0 1 1 0 0 0 0
3 0 50 0 4 10 0 1 0 0 0 0
90 0 0 0 120 0 0 2 0 1 0 0
40 0 60 0 50 0 0 2 1 1 0 0
200 0 100 0 90 0 0 2 0 0 0 0
6 0 30 0 60 0 0 2 1 1 1 0
80 0 0 0 0 0 0 2 0 0 0 0
9 0 8 0 70 0 0 0 1 1 0 1
150 0 90 0 200 0 0 0 1 1 0 1
20 0 40 0 6 10 0 0 1 1 0 1
20 0 6 10 40 0 0 0 1 1 0 1
5 0 3 10 9 0 0 0 1 1 1 1
2 0 60 0 3 0 0 0 1 1 0 1
14 4 60 0 50 0 0 0 1 1 0 1
""".strip()


@dataclass
class Block:
    text: str
    linked: int
    outside: int
    inside: bool
    heading: bool


class Element(NamedTuple):
    """An open element. ``level`` says how surely its own text is outside of the article, ``inner`` that of blocks inside."""

    tag: str
    level: int = 0
    inner: int = 0
    inside: bool = False
    heading: bool = False
    hidden: bool = False


class Page:
    """Reads a page in one pass; every step goes forward, so the time is linear whatever the markup."""

    def __init__(self, page: str) -> None:
        self.page = page
        self.blocks: list[Block] = []
        self.stack = [Element("")]
        self.ended: set[int] = set()  # inline elements of the stack that have ended below open blocks
        self.places: dict[str, list[int]] = defaultdict(list)  # open elements of each tag
        self.dropped: list[int] = []  # those of DROPPED
        self.parts: list[tuple[str, bool, bool]] = []  # text, linked, hidden
        self.last_end: dict[str, int] | None = None
        self.no_end: set[str] = set()
        self.last_quote = {q: page.rfind(q) for q in "\"'"}
        self.last_comment_end = page.rfind("-->")

    def read(self) -> list[Block]:
        page, at = self.page, 0
        while True:
            start = page.find("<", at)
            if start < 0:
                self.add(page[at:])
                break
            if start > at:
                self.add(page[at:start])
            at = self.markup(start)
        self.flush()
        return self.blocks

    def markup(self, at: int) -> int:
        """Reads what begins at a ``<``; the place to go on from."""
        page = self.page
        m = TAG.match(page, at)
        if m is None:
            if page.startswith("<!--", at) and at < self.last_comment_end:
                return page.find("-->", at + 2) + 3
            if page.startswith(("<!", "<?"), at):  # it ends at the next > or before the next tag
                end = UNCLOSED.match(page, at + 1).end()
                return end + page.startswith(">", end)
            if page.startswith("</>", at):
                return at + 3
            self.add("<")
            return at + 1
        tag, at = m[2].lower(), m.end()
        attributes, slash = {}, False
        if page.startswith(">", at):
            at += 1
        else:
            attributes, slash, at = self.attributes(at)
        if m[1]:
            self.end(tag)
            return at
        return self.start(tag, attributes, slash, at)

    def attributes(self, at: int) -> tuple[dict[str, str], bool, int]:
        """Attributes, whether a slash ends the tag, and the place behind it. A tag that is cut off ends before the next one."""
        page, out = self.page, {}
        while True:
            at = GAP.match(page, at).end()
            if page.startswith(">", at):
                return out, page[at - 1] == "/", at + 1
            if at >= len(page) or OPENS.match(page, at):
                return out, False, at
            m = NAME.match(page, at)
            name, at, value = m[0].lower(), m.end(), ""
            m = EQUALS.match(page, at)
            if m is not None:
                at = m.end()
                quote = page[at : at + 1]
                if quote and quote in "\"'":
                    end = page.find(quote, at + 1) if at < self.last_quote[quote] else -1
                    value = page[at + 1 : end] if end >= 0 else UNCLOSED.match(page, at + 1)[0]
                    at += len(value) + (2 if end >= 0 else 1)
                else:
                    value = BARE.match(page, at)[0]
                    at += len(value)
            out.setdefault(name, value)

    def add(self, text: str) -> None:
        if not self.dropped:
            self.parts.append((unescape(text), bool(self.places["a"]), self.stack[-1].hidden))

    def flush(self) -> None:
        if self.dropped:  # what a dropped element holds does not cut the text around it
            return
        top = self.stack[-1]
        parts = [p for p in self.parts if p[2] <= (top.level > 1)]
        self.parts.clear()
        text = " ".join("".join(p[0] for p in parts).split())
        if text:
            linked = sum(len(p[0].split()) for p in parts if p[1])
            self.blocks.append(Block(text, linked, top.level, top.inside, top.heading))

    def open(self, tag: str, *stops: str) -> int:
        """The place of the innermost open element of this tag above all open ``stops``, or 0."""
        here = self.places[tag][-1] if self.places[tag] else 0
        return here if all(not self.places[s] or self.places[s][-1] < here for s in stops) else 0

    def pop_to(self, place: int) -> None:
        """Ends the element at this place and all inside."""
        while len(self.stack) > place:
            at = len(self.stack) - 1
            if at in self.ended:
                self.ended.discard(at)
            else:
                self.places[self.stack[at].tag].pop()
            if self.dropped and self.dropped[-1] == at:
                self.dropped.pop()
            elif self.stack[at].tag in BLOCKS:
                self.flush()
            self.stack.pop()

    def end(self, tag: str) -> None:
        if tag in BLOCKS or tag in DROPPED:
            place = self.open(tag, *(CELLS - {tag} if tag not in ("table", "tr", "tbody", "thead", "tfoot") else ()))
            if self.dropped and place and place < self.dropped[-1] and self.stack[self.dropped[-1]].tag not in LEAVES and tag == "p":
                return
            if place:
                self.pop_to(place)
            elif tag == "p":
                self.flush()
        elif self.places[tag]:
            place = self.places[tag][-1]
            if place == len(self.stack) - 1:
                self.pop_to(place)
            else:  # blocks opened inside stay open
                self.places[tag].pop()
                self.ended.add(place)

    def start(self, tag: str, attributes: dict[str, str], slash: bool, at: int) -> int:
        if tag in RAW:
            return at if slash and tag not in RAW_TO_THE_END else self.behind(tag, at)
        if self.dropped and tag in ENDS_LEAVES and self.stack[self.dropped[-1]].tag in LEAVES:
            self.pop_to(self.dropped[-1])
        if tag == "br":
            self.add(" ")
            return at
        if tag in ("a", "button", "select") and self.open(tag, *CELLS):
            self.end(tag)
        if tag in DROPPED:
            if not slash and self.ends_later(tag, at):
                self.dropped.append(len(self.stack))
                self.push(self.stack[-1]._replace(tag=tag))
            return at
        if tag in BLOCKS:
            self.flush()
            if tag in CLOSE_P:
                place = self.open("p", *CELLS, *self.innermost_dropped())
            elif tag in ("li", "option"):
                place = self.open(tag, *LISTS, *self.innermost_dropped())
            elif tag in ("dd", "dt", "tr", "td", "th"):
                pair = {"dd": ("dd", "dt"), "dt": ("dd", "dt"), "td": ("td", "th"), "th": ("td", "th")}.get(tag, (tag,))
                place = max(self.open(t, *LISTS, *self.innermost_dropped()) for t in pair)
            else:
                place = 0
            if place:
                self.pop_to(place)
        if tag in VOID or slash and tag not in BLOCKS and tag != "a":
            return at
        top = self.stack[-1]
        level = outside(tag, attributes, top.inside) if tag not in ("html", "body") else 0
        inner = max(top.inner, level)
        inside = top.inside or tag in INSIDE_TAGS or attributes.get("role", "").strip().lower() == "main"
        hidden = top.hidden or is_hidden(attributes)
        block = tag in BLOCKS
        self.push(Element(tag, inner if block else top.level, inner, inside, top.heading or tag in HEADINGS, hidden))
        return at

    def innermost_dropped(self) -> tuple[str, ...]:
        return (self.stack[self.dropped[-1]].tag,) if self.dropped else ()

    def push(self, element: Element) -> None:
        self.places[element.tag].append(len(self.stack))
        self.stack.append(element)

    def behind(self, tag: str, at: int) -> int:
        """Behind a raw element. Without an end it goes to the end of the page (scripts and styles) or is empty."""
        m = None if tag in self.no_end else re.compile(rf"</{tag}(?![A-Za-z0-9:_-])[^>]*+>?", re.IGNORECASE | re.ASCII).search(self.page, at)
        if m is not None:
            return m.end()
        self.no_end.add(tag)
        return len(self.page) if tag in RAW_TO_THE_END else at

    def ends_later(self, tag: str, at: int) -> bool:
        if self.last_end is None:
            self.last_end = {m[2].lower(): m.start() for m in TAG.finditer(self.page) if m[1]}
        return self.last_end.get(tag, -1) >= at


def text_blocks(page: str) -> list[Block]:
    """The text blocks of a page, white space made single, empty ones left out."""
    return Page(page).read()


def is_hidden(attributes: dict[str, str]) -> bool:
    return bool(attributes) and ("hidden" in attributes or bool(NO_DISPLAY.search(attributes.get("style", ""))))


def outside(tag: str, attributes: dict[str, str], inside: bool) -> int:
    """How surely an element is no part of an article: 2 by its tag, role or name, 1 if its name only hints at it."""
    if tag in OUTSIDE_TAGS and not (tag == "header" and inside):
        return 2
    if not attributes:
        return 0
    role = attributes.get("role", "").strip().lower()
    if role in OUTSIDE_ROLES or is_hidden(attributes) or attributes.get("aria-hidden", "").strip().lower() == "true":
        return 2
    if tag in HEADINGS:
        return 0
    names = attributes.get("class", "").split() + [attributes.get("id", "")]
    level = max(named(frozenset(w.lower() for w in PARTS_OF_NAMES.findall(n))) for n in names)
    if tag in INSIDE_TAGS:  # an article in a list of comments is one of them
        return 2 if any(n.lower() in ("comment", "reply") for n in names) else 0
    return level


def named(words: frozenset[str]) -> int:
    sure, hints = words & OUTSIDE_NAMES, words & HINTS
    if not sure and not hints:
        return 0
    if words & NEGATIONS or words & INSIDE_NAMES and not words & NEVER_INSIDE:
        return 1
    return 2 if sure or words <= HINTS | FRAMES else 1


def described(blocks: list[Block]) -> np.ndarray:
    """FEATURES of each block."""
    n = len(blocks)
    x = np.zeros((n, len(FEATURES)))
    words = np.array([b.text.count(" ") + 1 for b in blocks], float)
    x[:, 0] = words
    x[:, 1] = 10 * np.minimum(1, np.array([b.linked for b in blocks]) / words)
    x[1:, 2:4] = x[:-1, 0:2]
    x[:-1, 4:6] = x[1:, 0:2]
    linked = x[:, 1] >= LINKED
    run = np.cumsum(np.diff(linked, prepend=False))  # numbers the runs of blocks that are linked or not
    x[:, 6] = np.where(linked, np.bincount(run)[run], 0)
    x[:, 7] = [b.outside for b in blocks]
    x[:, 8] = [b.inside for b in blocks]
    x[:, 9] = any(b.inside and b.outside < 2 for b in blocks)
    x[:, 10] = [b.heading for b in blocks]
    return x


@dataclass
class Tree:
    """A split (column, value, left if at most, right) or a leaf (column -1)."""

    column: int
    value: float
    left: Tree | None = None
    right: Tree | None = None

    def __call__(self, x: np.ndarray) -> np.ndarray:
        if self.column < 0:
            return np.full(len(x), self.value >= 0.5)
        low = x[:, self.column] <= self.value
        out = np.empty(len(x), bool)
        out[low], out[~low] = self.left(x[low]), self.right(x[~low])
        return out


def grown(x: np.ndarray, y: np.ndarray, depth: int) -> Tree:
    """A tree by Gini impurity; of equal splits the first column and the smallest value."""
    share = float(y.mean())
    if depth == 0 or share in (0.0, 1.0):
        return Tree(-1, share)
    best = None
    for c in range(x.shape[1]):
        values = np.unique(x[:, c])
        for v in (values[:-1] + values[1:]) / 2:
            low = x[:, c] <= v
            cost = sum(p * (1 - p) * k.sum() for k in (low, ~low) for p in (y[k].mean(),))
            if best is None or cost < best[0] - 1e-9:
                best = (cost, c, v)
    if best is None:
        return Tree(-1, share)
    _, c, v = best
    low = x[:, c] <= v
    return Tree(c, float(v), grown(x[low], y[low], depth - 1), grown(x[~low], y[~low], depth - 1))


def trained(table: str = LABELLED, depth: int = 9) -> Tree:
    rows = np.array([line.split() for line in table.splitlines()], float)
    return grown(rows[:, :-1], rows[:, -1], depth)


def extracted(page: str, tree: Tree) -> str:
    blocks = text_blocks(page)
    if not blocks:
        return ""
    return "\n".join(b.text for b, keep in zip(blocks, tree(described(blocks)), strict=True) if keep)


def _extracted(tree: Tree, names: list[str]):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = [extracted(page or "", tree) for page in part.column("__html").to_pylist()]
            counts = [len(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [part.column(c) for c in names] + [pa.array(texts, pa.string()), pa.array(counts, pa.int64())],
                [*names, "text", "n_chars"],
            )

    return run


def main_text(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url"), html_col: str = "html") -> DataFrame:
    """The columns ``keep``, then text and n_chars (its code points), one row per page.

    Null html counts as empty; a page without main text has an empty text. Blocks come in page order, joined by one \\n,
    with character references decoded and white space made single. Rows that repeat come out as often. Other
    columns are not read, and kept ones called text or n_chars give way to the results. An empty table gives no rows.
    A tag that is cut off ends before the next one, a comment without an end at the next >; a script or style without an
    end goes to the end of the page, other elements that are dropped are then taken as empty. Time grows with the length.
    """
    keep = tuple(c for c in keep if c not in ("text", "n_chars"))
    rows = pages.select(*keep, F.col(html_col).alias("__html"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.select(*keep).schema)
    return rows.mapInArrow(_extracted(trained(), list(keep)), f"{schema}, text string, n_chars long")
