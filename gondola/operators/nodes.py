"""Pages to elements.

The one Python step of the library. A page stays one row: its elements and texts become an
array in document order, so every later selection is a JVM expression inside that row and
extraction needs no shuffle. The subtree of the node at index ``i`` is ``i+1 .. last``.
"""

from __future__ import annotations

import json
import re
import sys
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# executors get this module with the job, whatever their import path is
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NODES = "nodes"
PARSE_ERROR = "parse_error"

DOCUMENT = "#document"
TEXT = "#text"
RAW_TEXT = "#raw"  # text of script and style: not part of the page text

# Elements without an end tag, and elements with raw text.
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset(["script", "style"])
JSONLD_TYPE = "application/ld+json"

# a number of so many digits is more than Python reads; eight say as much
LONG_REFERENCE = re.compile(r"&#(\d{4000,})")

#: A file in parts: ``part_no`` orders them, ``outside`` tells that no element goes on across the end
PART = ["path", "part_no", "html", "n_bytes", "outside"]
PART_SCHEMA = "path string, part_no long, html string, n_bytes long, outside boolean"

# output batches are cut at this many nodes, to bound the memory of a Python worker
NODES_PER_BATCH = 100_000

NODE_TYPE = T.StructType(
    [
        T.StructField("tag", T.StringType()),
        T.StructField("classes", T.ArrayType(T.StringType())),
        T.StructField("attrs", T.MapType(T.StringType(), T.StringType())),
        T.StructField("text", T.StringType()),
        T.StructField("parent", T.IntegerType()),
        T.StructField("last", T.IntegerType()),
        T.StructField("depth", T.IntegerType()),
    ]
)


def plain_json(text: str) -> str:
    """JSON that repeats keys or has numbers like NaN, as JSON without: the last of equal keys counts, and no number is
    null. Any other text is returned as it is, JSON or not.
    """
    loose = False

    def members(pairs: list[tuple[str, object]]) -> dict[str, object]:
        nonlocal loose
        found = dict(pairs)
        loose = loose or len(found) < len(pairs)
        return found

    def no_number(_: str) -> None:
        nonlocal loose
        loose = True

    try:
        value = json.loads(text, object_pairs_hook=members, parse_constant=no_number)
    except (ValueError, RecursionError):
        return text
    return json.dumps(value, ensure_ascii=False) if loose else text


def _readable(html: str) -> str:
    return LONG_REFERENCE.sub(lambda m: "&#" + (m[1].lstrip("0")[:8] or "0"), html)


class _NodeBuffer(HTMLParser):
    """Collects the nodes of many pages column by column.

    Broken markup follows one rule: void tags never open; an end tag closes the nearest open
    match and everything above it; what is never closed ends with the document. A declaration that
    the tokenizer refuses is text, up to its end or the next tag, and the page goes on behind it.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.page_starts = [0]
        self.errors: list[str | None] = []
        self.tag: list[str] = []
        self.text: list[str | None] = []
        self.parent: list[int | None] = []
        self.last: list[int] = []
        self.depth: list[int] = []
        self.class_starts = [0]
        self.classes: list[str] = []
        self.attr_starts = [0]
        self.attr_keys: list[str] = []
        self.attr_values: list[str] = []

    def add_page(self, html: str | None) -> None:
        self.base = len(self.tag)
        self.stack: list[int] = []
        self.open_tags: Counter[str] = Counter()
        self.pending: list[str] = []
        self.jsonld_at = -1
        self._open(DOCUMENT, [])
        self.error: str | None = None
        self.reset()
        self.feed(_readable(html or ""))
        self.close()
        self._end_text()
        end = len(self.tag) - self.base - 1
        for i in self.stack:
            self.last[self.base + i] = end
        self.page_starts.append(len(self.tag))
        self.errors.append(self.error)

    def _add(self, tag: str, text: str | None) -> int:
        at = len(self.tag) - self.base
        self.tag.append(tag)
        self.text.append(text)
        self.parent.append(self.stack[-1] if self.stack else None)
        self.last.append(at)
        self.depth.append(len(self.stack))
        return at

    def _open(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        at = self._add(tag, None)
        if attrs:
            values = {k: v or "" for k, v in attrs}
            if "class" in values:
                names = values["class"].split()
                self.classes.extend(names)
                values["class"] = " ".join(names)
            self.attr_keys.extend(values)
            self.attr_values.extend(values.values())
            if tag == "script" and values.get("type") == JSONLD_TYPE:
                self.jsonld_at = at
        self.class_starts.append(len(self.classes))
        self.attr_starts.append(len(self.attr_keys))
        if tag not in VOID_TAGS:
            self.stack.append(at)
            self.open_tags[tag] += 1

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self._end_text()
        self._open(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        self._end_text()
        if not self.open_tags[tag]:
            return
        end = len(self.tag) - self.base - 1
        closed = None
        while closed != tag:
            i = self.stack.pop()
            closed = self.tag[self.base + i]
            self.last[self.base + i] = end
            self.open_tags[closed] -= 1

    def parse_html_declaration(self, i: int) -> int:
        try:
            return HTMLParser.parse_html_declaration(self, i)
        except AssertionError as e:  # such as <![foo[x]]>
            self.error = self.error or f"{type(e).__name__}: {e}"
        ends = [k for k in (self.rawdata.find(">", i) + 1, self.rawdata.find("<", i + 1)) if k > 0]
        end = min(ends, default=len(self.rawdata))
        self.handle_data(self.rawdata[i:end])
        return end

    def updatepos(self, i: int, j: int) -> int:
        return j  # line numbers are not needed

    def handle_comment(self, data: str) -> None:
        self._end_text()

    handle_decl = handle_pi = unknown_decl = handle_comment

    def handle_data(self, data: str) -> None:
        self.pending.append(data)  # one text may come in several pieces

    def _end_text(self) -> None:
        if not self.pending:
            return
        piece = "".join(self.pending).strip()
        self.pending = []
        if piece:
            raw = self.tag[self.base + self.stack[-1]] in RAW_TAGS
            if raw and self.stack[-1] == self.jsonld_at:
                piece = plain_json(piece)
            self._add(RAW_TEXT if raw else TEXT, piece)
            self.class_starts.append(len(self.classes))
            self.attr_starts.append(len(self.attr_keys))

    def columns(self) -> tuple[pa.Array, pa.Array]:
        starts = lambda xs: pa.array(xs, pa.int32())
        text = lambda xs: pa.array(xs, pa.string())
        whole = lambda xs: pa.array(xs, pa.int32())
        nodes = pa.StructArray.from_arrays(
            [
                text(self.tag),
                pa.ListArray.from_arrays(starts(self.class_starts), text(self.classes)),
                pa.MapArray.from_arrays(starts(self.attr_starts), text(self.attr_keys), text(self.attr_values)),
                text(self.text),
                whole(self.parent),
                whole(self.last),
                whole(self.depth),
            ],
            names=NODE_TYPE.names,
        )
        return pa.ListArray.from_arrays(starts(self.page_starts), nodes), text(self.errors)


def _pages_to_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        htmls = batch.column(batch.num_columns - 1)
        others = batch.columns[:-1]
        names = [*batch.schema.names[:-1], NODES, PARSE_ERROR]
        done = 0
        buffer = _NodeBuffer()
        for at in range(batch.num_rows):
            buffer.add_page(htmls[at].as_py())
            if len(buffer.tag) >= NODES_PER_BATCH or at + 1 == batch.num_rows:
                kept = [c.slice(done, at + 1 - done) for c in others]
                yield pa.RecordBatch.from_arrays([*kept, *buffer.columns()], names=names)
                done = at + 1
                buffer = _NodeBuffer()


class _Boundary(HTMLParser):
    """Reads markup by the rules of ``_NodeBuffer``, and knows no more than which tags are open and whether a text is."""

    error = None

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[str] = []
        self.open_tags: Counter[str] = Counter()
        self.in_text = False

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.in_text = False
        if tag not in VOID_TAGS:
            self.stack.append(tag)
            self.open_tags[tag] += 1

    def handle_endtag(self, tag: str) -> None:
        self.in_text = False
        closed = None
        while self.open_tags[tag] and closed != tag:
            closed = self.stack.pop()
            self.open_tags[closed] -= 1

    def handle_comment(self, data: str) -> None:
        self.in_text = False

    handle_decl = handle_pi = unknown_decl = handle_comment

    def handle_data(self, data: str) -> None:
        self.in_text = True

    parse_html_declaration, updatepos = _NodeBuffer.parse_html_declaration, _NodeBuffer.updatepos


def ends_outside(html: str) -> bool:
    """Whether markup that begins outside of all elements ends so too, behind a whole tag. What follows is then parsed as if
    it stood alone: no element, text, comment or script goes on across the end.
    """
    reader = _Boundary()
    reader.feed(_readable(html))
    return not (reader.stack or reader.rawdata or reader.cdata_elem or reader.in_text)


def parts_of(end: str, least: int):
    """Joins the pieces of each block, in order and each with its ``end``, to parts of at least ``least`` bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def part() -> pa.RecordBatch:
            html = "".join(held)
            row = (path, block + n, html, size, ends_outside(html))
            return pa.RecordBatch.from_arrays([pa.array([v]) for v in row], names=PART)

        path, block, n, size, held = None, None, 0, 0, []
        for batch in batches:
            for of, at, html, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and (at != block or of != path or size >= least):
                    yield part()
                    n, size, held = n + 1, 0, []
                if at != block or of != path:
                    path, block, n = of, at, 0
                held.append(html + end)
                size += length + len(end)
        if held:
            yield part()

    return run


def outside_again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at = PART.index("html")
    for batch in batches:
        ends = pa.array([ends_outside(html.as_py()) for html in batch.column(at)], pa.bool_())
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], ends], names=PART)


def page_nodes(pages: DataFrame, *keep: str, html: str = "html") -> DataFrame:
    """One row per page with its ``nodes`` array, and ``parse_error`` where markup was refused and read as text.

    ``keep`` names the columns to carry along; the page text itself is dropped. Wide columns
    that are not named never reach Python.
    """
    schema = T.StructType(
        [pages.schema[c] for c in keep]
        + [T.StructField(NODES, T.ArrayType(NODE_TYPE)), T.StructField(PARSE_ERROR, T.StringType())]
    )
    return pages.select(*keep, html).mapInArrow(_pages_to_nodes, schema)


def element_rows(nodes: DataFrame) -> DataFrame:
    """The node arrays as rows: one per element or text, numbered by ``pre``."""
    kept = [c for c in nodes.columns if c not in (NODES, PARSE_ERROR)]
    return nodes.select(*kept, F.posexplode(NODES).alias("pre", "node")).select(*kept, "pre", "node.*")
