"""Passages that occur more than once, removed wherever they occur.

A window is a number of consecutive words of one text; it recurs if its words also start anywhere else.
1. Anchors. Every window has a smallest hash among its shorter n-grams, and equal windows have the same one. Only
   these smallest hashes, a few in a hundred words, are counted over the corpus.
2. Confirmation. Windows whose anchor occurs more than once are counted in full, by two hashes of their words.
   Nearly all of them recur, so only those that don't are named. Runs of the others are a text's passages.
3. Location. Texts are streamed in shards. Each shard compiles an Aho-Corasick automaton over words from the
   passages confirmed for its texts and reads every text through it; all that the automaton finds goes. The hashes
   of 2 have located these passages already: the automaton confirms them word by word.
Texts that are equal as a whole are counted once with their number, so a group of copies costs one text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import compress

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gondola.llm import words as W
from gondola.session import materialise

GRAM = 8
WORD = re.compile(r"[^\x20\x09-\x0D]+")
KEY = ["r1", "r2"]
ANCHORS = "r1 long, r2 long, doc long, n_words long, anchors array<long>"
WINDOWS = "w1 long, w2 long, r1 long, r2 long, at int, copies int"
FOUND = "doc long, n_words long, n_removed long, spans array<struct<start:long,end:long>>, kept_text string"
NULL_ID = -(1 << 63)


def _sliding(x: np.ndarray, size: int, best: np.ufunc) -> np.ndarray:
    """The best of each ``size`` consecutive values."""
    width, out = 1, x
    while 2 * width <= size:
        out = best(out[:-width], out[width:])
        width *= 2
    return best(out[: len(x) - size + 1], out[size - width : size - width + len(x) - size + 1])


def smallest_grams(hashes: np.ndarray, rows: np.ndarray, size: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word and smallest n-gram hash of each window; and all n-gram hashes by first word (0: none)."""
    n = len(hashes)
    gram = min(gram, size)
    if n < size:
        return np.zeros(0, np.int64), np.zeros(0, W.U), np.zeros(0, W.U)
    grams = np.zeros(n, W.U)
    at = np.arange(n - gram + 1)
    grams[at] = W.run_hashes(hashes, at, at + gram, W.WORD_BASE) | W.U(1)
    starts = np.flatnonzero(rows[: n - size + 1] == rows[size - 1 :])
    lows = _sliding(grams[: n - gram + 1], size - gram + 1, np.minimum)
    return starts, lows[starts], grams


def anchors_of(hashes: np.ndarray, rows: np.ndarray, size: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of each place that is the smallest of some window around it; at most two a row and hash."""
    starts, lows, grams = smallest_grams(hashes, rows, size, gram)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, W.U)
    reach = size - min(gram, size) + 1
    highest = np.zeros(len(hashes) + reach - 1, W.U)  # the largest of the smallest, over windows around a place
    highest[starts + reach - 1] = lows
    highest = _sliding(highest, reach, np.maximum)
    at = np.flatnonzero((grams == highest) & (grams != 0))
    rows, grams = rows[at], grams[at]
    order = np.lexsort((grams, rows))
    rows, grams = rows[order], grams[order]
    third = np.zeros(len(rows), bool)
    third[2:] = (rows[2:] == rows[:-2]) & (grams[2:] == grams[:-2])
    return rows[~third], grams[~third]


def _anchors(size: int, gram: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for first, n, data, offsets in W.text_slices(part.column("text")):
                hashes, _, _, rows = W.word_hashes(data, offsets)
                of, found = anchors_of(hashes, rows, size, gram)
                yield pa.RecordBatch.from_arrays(
                    [part.column(c).slice(first, n) for c in (*KEY, "doc")]
                    + [pa.array(np.bincount(rows, minlength=n)), W.lists(W.signed(found), np.bincount(of, minlength=n))],
                    [*KEY, "doc", "n_words", "anchors"],
                )

    return run


def candidate_windows(hashes: np.ndarray, rows: np.ndarray, n: int, wanted: list, size: int, gram: int) -> np.ndarray:
    """First words of windows whose anchor is one of those wanted for their row."""
    starts, lows, _ = smallest_grams(hashes, rows, size, gram)
    edges = np.searchsorted(rows[starts], np.arange(n + 1))
    hit = np.zeros(len(starts), bool)
    for k in range(n):
        a, z = edges[k], edges[k + 1]
        if z > a and wanted[k] is not None:
            hit[a:z] = np.isin(lows[a:z], wanted[k].view(W.U))
    return starts[hit]


def _windows(size: int, gram: int):
    """Windows of a text whose anchor recurs."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            r1, r2, copies = (part.column(c).to_numpy() for c in (*KEY, "copies"))
            recurring = part.column("recurring")
            for first, n, data, offsets in W.text_slices(part.column("text")):
                hashes, _, _, rows = W.word_hashes(data, offsets)
                wanted = [x.values.to_numpy() for x in recurring.slice(first, n)]
                at = candidate_windows(hashes, rows, n, wanted, size, gram)
                if len(at):
                    of = rows[at]
                    begins = np.searchsorted(rows, of)
                    yield pa.RecordBatch.from_arrays(
                        [W.signed(W.run_hashes(hashes, at, at + size, b)) for b in (W.BYTE_BASE, W.OTHER_BASE)]
                        + [pa.array(r1[first + of]), pa.array(r2[first + of]), pa.array((at - begins).astype(np.int32)), pa.array(copies[first + of].astype(np.int32))],
                        ["w1", "w2", *KEY, "at", "copies"],
                    )

    return run


def runs(places: np.ndarray) -> list[tuple[int, int]]:
    """First and last of each run of consecutive places."""
    if not len(places):
        return []
    cut = np.flatnonzero(np.diff(places) > 1)
    return list(zip(places[np.append(0, cut + 1)].tolist(), places[np.append(cut, len(places) - 1)].tolist(), strict=True))


def compiled(phrases: set[tuple[int, ...]]) -> ahocorasick.Automaton:
    """An automaton over sequences of word numbers."""
    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for phrase in phrases:
        automaton.add_word(phrase, len(phrase))
    automaton.make_automaton()
    return automaton


def passages(text: str, recurring: np.ndarray, single: np.ndarray | None, size: int, gram: int) -> list[tuple[int, int]]:
    """The recurring passages of a text: first and last window of each."""
    data = np.frombuffer(text.encode(), np.uint8)
    hashes, _, _, rows = W.word_hashes(data, np.array([0, len(data)]))
    at = candidate_windows(hashes, rows, 1, [recurring], size, gram)
    return runs(at if single is None else np.setdiff1d(at, single))


def _located(size: int, gram: int, shard_words: int):
    def shard(rows: list[tuple]) -> pa.RecordBatch:
        numbers: dict[str, int] = {}
        phrases = set()
        for _, found, repeated in rows:
            for a, z in repeated:
                for at in (*range(a, z, size), z):
                    phrases.add(tuple([numbers.setdefault(w, len(numbers) + 1) for w in found[at : at + size]]))
        automaton = compiled(phrases) if phrases else None
        out = []
        for doc, found, _ in rows:
            spans, removed, kept = [], 0, found
            if automaton is not None and len(found) >= size:
                ends = [e for e, _ in automaton.iter(tuple([numbers.get(w, 0) for w in found]))]
                if ends:
                    steps = np.zeros(len(found) + 1, np.int64)
                    ends = np.array(ends)
                    np.add.at(steps, ends - size + 1, 1)
                    np.add.at(steps, ends + 1, -1)
                    gone = np.cumsum(steps)[:-1] > 0
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
                    spans = [{"start": a, "end": z} for a, z in edge.reshape(-1, 2).tolist()]
                    removed, kept = int(gone.sum()), list(compress(found, ~gone))
            out.append((doc, len(found), removed, spans, " ".join(kept)))
        types = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)],
            ["doc", "n_words", "n_removed", "spans", "kept_text"],
        )

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, n = [], 0
        for part in parts:
            columns = [part.column(c) for c in ("doc", "text", "recurring", "single")]
            for k in range(part.num_rows):
                doc, text = columns[0][k].as_py(), columns[1][k].as_py()
                recurring, single = (c[k].values.to_numpy() if c[k].is_valid else None for c in columns[2:])
                found = WORD.findall(text)
                rows.append((doc, found, passages(text, recurring, single, size, gram) if recurring is not None else []))
                n += len(found)
                if n >= shard_words or len(rows) >= 4096:
                    yield shard(rows)
                    rows, n = [], 0
        if rows:
            yield shard(rows)

    return run


def repeated_phrases(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 35, shard_words: int = 200_000
) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, spans (word ranges that go), kept_text.

    Words are runs of characters other than [\\x20\\x09-\\x0D], unchanged. Each word goes that a window of ``size``
    words covers whose words also start anywhere else, in the same document too; overlapping places count.
    Kept words are joined by one space. Null and empty texts have no words. Ids are integers or null and may
    repeat: every row is a place of its own. Other columns are not read. An empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("doc"),
        F.xxhash64(F.lit(1), text).alias("r1"),
        F.xxhash64(F.lit(2), text).alias("r2"),
        text.alias("text"),
    )
    anchored = materialise(keyed.mapInArrow(_anchors(size, GRAM), ANCHORS), "anchors")
    one = anchored.filter(F.col("n_words") >= size).groupBy(*KEY)  # equal texts have equal anchors
    one = one.agg(F.min("doc").alias("doc"), F.count("*").alias("n"), F.first("anchors").alias("anchors"))
    copies = F.when(F.col("n") > 1, 2).otherwise(1).alias("copies")
    places = materialise(one.select(*KEY, "doc", copies, F.explode("anchors").alias("anchor")), "anchor-places")
    recurring = places.groupBy("anchor").agg(F.sum("copies").alias("n")).filter("n > 1").select("anchor")
    recurring = materialise(recurring, "recurring")  # written sums let the joins below split hot anchors and windows
    candidates = (
        places.join(recurring, "anchor", "left_semi")
        .groupBy(*KEY, "doc")
        .agg(F.collect_set("anchor").alias("recurring"), F.max("copies").alias("copies"))
    )
    candidates = materialise(candidates, "candidates")
    windows = (
        keyed.join(candidates, [*KEY, "doc"])
        .select(*KEY, "copies", "recurring", "text")
        .mapInArrow(_windows(size, GRAM), WINDOWS)
    )
    # most candidates recur: those that do not are named, by the one place they have, and taken away
    counted = F.sum(F.shiftleft(F.col("copies").cast("long"), 32) + F.col("at")).alias("sum")  # a count above, a place below
    single = windows.groupBy("w1", "w2").agg(counted, *[F.min(k).alias(k) for k in KEY]).filter(F.shiftright("sum", 32) == 1)
    single = single.select(*KEY, F.col("sum").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("at")).groupBy(*KEY).agg(F.collect_set("at").alias("single"))
    repeated = materialise(candidates.select(*KEY, "recurring").join(single, KEY, "left"), "repeated")
    found = (
        keyed.join(repeated, KEY, "left")
        .select("doc", "text", "recurring", "single")
        .mapInArrow(_located(size, GRAM, shard_words), FOUND)
    )
    return found.select(
        F.when(F.col("doc") != NULL_ID, F.col("doc")).alias("doc_id"), "n_words", "n_removed", "spans", "kept_text"
    )
