"""Repeated lines, found by one range partitioning of line hashes.

Hashes of lines are dealt out by range of (hash, document), each range sorted by hash, document
(largest first) and position, and streamed: the first document of a run of equal hashes keeps its
lines, the others lose them once enough documents are seen. As ranges split between documents, a line
that a third of all documents holds spreads over many tasks; what a range cannot decide alone, as
its first or last run goes on elsewhere, is decided by adding up one short summary per range.

The result is a bitmap of the lines that stay, not text. ``apply_bitmaps`` makes the text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gondola.llm import words as W
from gondola.session import materialise

LINES = "h1 long, h2 long, doc long, row long, pos int"
STREAMED = "h1 long, h2 long, doc long, row long, pos int, n_docs long, decided boolean"
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[0x41:0x5B] += 32
NULL_ID = -(1 << 63)


def _lines(min_points: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def tables():
            for part in parts:
                ids = part.column("doc").to_numpy(zero_copy_only=False)
                marks = part.column("row").to_numpy(zero_copy_only=False)
                for first, _, data, offsets in W.text_slices(part.column("text")):
                    yield key_hashes(data, offsets, min_points) | {"first": first, "ids": ids, "marks": marks}

        for t in tables():
            rows = t["rows"] + t["first"]
            if len(rows):
                yield pa.RecordBatch.from_arrays(
                    [W.signed(t["h1"]), W.signed(t["h2"]), pa.array(t["ids"][rows]), pa.array(t["marks"][rows]), pa.array(t["pos"])],
                    ["h1", "h2", "doc", "row", "pos"],
                )

    return run


def key_hashes(data: np.ndarray, offsets: np.ndarray, min_points: int) -> dict:
    """Two hashes, row and place of each line whose key is long enough.

    A key is the line stripped of white space at both ends, A-Z lower-cased.
    """
    breaks = data == 0x0A
    starts, ends, rows = W.spans(np.where(breaks, np.uint8(0x20), np.uint8(0x61)), offsets)
    # runs without a break are the lines that aren't empty; the place counts the breaks before
    before = np.zeros(len(data) + 1, np.int64)
    np.cumsum(breaks, out=before[1:])
    pos = before[starts] - before[offsets[rows]]
    solid = np.flatnonzero(W.NOT_WHITE[data])
    low, high = np.searchsorted(solid, starts), np.searchsorted(solid, ends)
    some = high > low
    rows, pos, low, high = rows[some], pos[some], low[some], high[some]
    starts, ends = solid[low], solid[high - 1] + 1
    points = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=points[1:])
    long = points[ends] - points[starts] >= min_points
    rows, pos, starts, ends = rows[long], pos[long], starts[long], ends[long]
    bytes_ = LOWERED[data].astype(W.U) + W.U(1)
    return {
        "h1": W.run_hashes(bytes_, starts, ends),
        "h2": W.run_hashes(bytes_, starts, ends, W.OTHER_BASE),
        "rows": rows,
        "pos": pos.astype(np.int32),
    }


class Range:
    """The runs of one range. ``out`` gathers rows that go, rows still open, and open runs' summaries."""

    def __init__(self, min_docs: int) -> None:
        self.min_docs = min_docs
        self.key = self.largest = self.last = None
        self.docs, self.first_run, self.held, self.out = 0, True, [], []

    def rows(self, c: list[np.ndarray], decided: bool) -> None:
        self.emit(c, np.zeros(len(c[0]), np.int64), decided)

    def emit(self, c: list[np.ndarray], n_docs: np.ndarray, decided: bool) -> None:
        if len(n_docs):
            flags = pa.array(np.full(len(n_docs), decided))
            names = ["h1", "h2", "doc", "row", "pos", "n_docs", "decided"]
            self.out.append(pa.RecordBatch.from_arrays([*map(pa.array, c), pa.array(n_docs), flags], names))

    def summary(self) -> None:
        one = [np.array([x], np.int64) for x in (*self.key, self.largest, 0)]
        self.emit([*one, np.array([-1], np.int32)], np.array([self.docs], np.int64), False)

    def close(self) -> None:
        """The run has ended within the range. If it also began there, its rows are decided."""
        if self.key is not None:
            if self.first_run:
                self.summary()
            self.key, self.first_run, self.held = None, False, []

    def feed(self, c: list[np.ndarray], number: np.ndarray) -> None:
        """Rows of one run, with the number of their document in it."""
        key = (c[0][0], c[1][0])
        if key != self.key:
            self.close()
            self.key, self.largest = key, c[2][0]
        self.docs, self.last = int(number[-1]), c[2][-1]
        if self.first_run:
            self.rows(c, False)
        elif self.docs < self.min_docs:
            self.held.append((c, number))
        else:
            for rows, n in [*self.held, (c, number)]:
                self.rows([x[n > 1] for x in rows], True)
            self.held = []

    def batch(self, c: list[np.ndarray]) -> None:
        n = len(c[0])
        new_run, new_doc = np.ones(n, bool), np.ones(n, bool)
        new_run[1:] = (c[0][1:] != c[0][:-1]) | (c[1][1:] != c[1][:-1])
        new_doc[1:] = new_run[1:] | (c[2][1:] != c[2][:-1])
        begins = np.flatnonzero(new_run)
        ends = np.append(begins[1:], n)
        seen = np.cumsum(new_doc)
        number = seen - np.repeat(seen[begins], ends - begins) + 1
        if self.key == (c[0][0], c[1][0]):
            number[: ends[0]] += self.docs - (c[2][0] == self.last)
        self.feed([x[: ends[0]] for x in c], number[: ends[0]])
        if len(begins) > 1:
            self.close()
            a, z = ends[0], begins[-1]  # runs wholly inside the batch
            total = np.repeat(number[ends[1:-1] - 1], ends[1:-1] - begins[1:-1])
            go = (total >= self.min_docs) & (number[a:z] > 1)
            self.rows([x[a:z][go] for x in c], True)
            self.feed([x[z:] for x in c], number[z:])

    def end(self) -> None:
        """The last run may go on in the next range."""
        for rows, _ in self.held:
            self.rows(rows, False)
        if self.key is not None:
            self.summary()


def _streamed(min_docs: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = Range(min_docs)
        for part in parts:
            if part.num_rows:
                state.batch([part.column(i).to_numpy(zero_copy_only=False) for i in range(5)])
                yield from state.out
                state.out = []
        state.end()
        yield from state.out

    return run


def _bitmaps(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        lines = part.column("n_lines").to_numpy(zero_copy_only=False)
        dropped = part.column("dropped")
        packed = []
        for n, gone in zip(lines, dropped, strict=True):
            keep = np.ones(n, bool)
            if gone.is_valid:
                keep[gone.values.to_numpy()] = False
            packed.append(zlib.compress(np.packbits(keep).tobytes(), 1))
        counts = pc.fill_null(pc.list_value_length(dropped), 0).cast(pa.int64())
        yield pa.RecordBatch.from_arrays(
            [part.column("doc"), part.column("row"), part.column("n_lines"), counts, pa.array(packed, pa.binary())],
            ["doc", "row", "n_lines", "n_dropped", "keep_bits"],
        )


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("doc"), F.xxhash64(text).alias("row"), text.alias("text")
    )


def line_bitmaps(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_points: int = 20, min_docs: int = 3
) -> DataFrame:
    """One row per document: doc, row, n_lines, n_dropped, keep_bits (zlib over packed bits, first line first).

    Lines end at \\n. A line's key is the line stripped of white space at both ends, A-Z lower-cased.
    Keys of at least ``min_points`` code points found in at least ``min_docs`` documents lose their lines in
    all documents but that with the largest id, which keeps all of them.

    ``doc`` is the id (an integer; null becomes the smallest long) and ``row`` a hash of the text, so that rows
    which share an id but not the text stay apart; rows that repeat both are one document. Null texts
    count as one empty line. Other columns are not read. An empty table gives no rows.
    """
    keyed = _keyed(docs, id_col, text_col)
    lines = materialise(keyed.mapInArrow(_lines(min_points), LINES), "lines")
    order = ["h1", "h2", F.desc("doc")]
    streamed = materialise(
        lines.repartitionByRange(*order).sortWithinPartitions(*order, "row", "pos").mapInArrow(_streamed(min_docs), STREAMED),
        "dropped-lines",
    )
    totals = (
        streamed.filter("pos < 0")
        .groupBy("h1", "h2")
        .agg(F.sum("n_docs").alias("total"), F.max("doc").alias("largest"))
        .filter(F.col("total") >= min_docs)
    )
    totals = materialise(totals, "line-totals")  # at most two rows a range, so small enough to send to all tasks
    opened = (
        streamed.filter("pos >= 0 AND NOT decided")
        .join(totals, ["h1", "h2"])
        .filter("doc <> largest")
    )
    gone = streamed.filter("decided").select("doc", "row", "pos").unionByName(opened.select("doc", "row", "pos"))
    gone = gone.groupBy("doc", "row").agg(F.collect_set("pos").alias("dropped"))
    sized = keyed.select("doc", "row", (F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).alias("n_lines"))
    sized = sized.groupBy("doc", "row").agg(F.max("n_lines").cast("long").alias("n_lines"))
    return sized.join(gone, ["doc", "row"], "left").mapInArrow(
        _bitmaps, "doc long, row long, n_lines long, n_dropped long, keep_bits binary"
    )


def _kept(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        names = part.schema.names
        texts = []
        for text, gone, bits in zip(
            part.column("__text").to_pylist(), part.column("n_dropped").to_pylist(), part.column("keep_bits").to_pylist(), strict=True
        ):
            if gone and text is not None:
                all_lines = text.split("\n")
                keep = np.unpackbits(np.frombuffer(zlib.decompress(bits), np.uint8), count=len(all_lines))
                text = "\n".join(x for x, k in zip(all_lines, keep, strict=True) if k)
            texts.append(text)
        columns = [pa.array(texts, pa.string()) if n == "__text" else part.column(n) for n in names if n != "keep_bits"]
        yield pa.RecordBatch.from_arrays(columns, [n for n in names if n != "keep_bits"])


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with the lines that stay, all columns as they were, then n_lines and n_dropped.

    A null text stays null. Input columns named n_lines or n_dropped give way to the new ones.
    """
    added = ["n_lines", "n_dropped", "keep_bits"]
    docs = docs.drop(*added)
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.withColumns(
        {"__doc": F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)), "__row": F.xxhash64(text)}
    ).withColumnRenamed(text_col, "__text")
    joined = keyed.join(
        bitmaps.select(F.col("doc").alias("__doc"), F.col("row").alias("__row"), *added), ["__doc", "__row"]
    ).drop("__doc", "__row")
    schema = joined.drop("keep_bits").schema
    return joined.mapInArrow(_kept, schema).withColumnRenamed("__text", text_col)
