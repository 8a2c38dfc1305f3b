"""Benchmark decontamination by greedy string tiling.

Seeds are runs of a few tokens. Documents that share a seed with a benchmark item are compared with it by
running Karp-Rabin: the longest common runs are tiled first, no token twice, then shorter ones down to the
seed length. The share of an item's tokens under tiles is its coverage; the order of tiles does not
matter, so passages that were moved about still count.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gondola.llm import words as W
from gondola.session import materialise

NULL_ID = -(1 << 63)
FILTER_BITS = 1 << 24
CHUNK = 1 << 16
ITEM_SEEDS = "item long, n_tokens long, seed long, at long"
TILED = "doc long, row long, item long, n_tokens long, covered long, n_tiles long"


def _item_seeds(size: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            ids = part.column("item").to_numpy()
            for first, n, data, offsets in W.text_slices(part.column("text")):
                hashes, _, _, rows = W.word_hashes(data, offsets, W.ALNUM)
                at, seeds = W.window_hashes(hashes, rows, size)
                counts = np.bincount(rows, minlength=n)
                of = rows[at]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[first + of]), pa.array(counts[of]), W.signed(seeds), pa.array(at - np.searchsorted(rows, of))],
                    ["item", "n_tokens", "seed", "at"],
                )

    return run


def _filter_chunks(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        packed = []
        for bits in part.column("bits"):
            on = np.zeros(CHUNK, bool)
            on[bits.values.to_numpy()] = True
            packed.append(np.packbits(on, bitorder="little").tobytes())
        yield pa.RecordBatch.from_arrays([part.column("chunk"), pa.array(packed, pa.binary())], ["chunk", "packed"])


def seed_filter(seeds: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """A bit table of seeds of fixed size (2 MB), whatever their number; a seed that is not set occurs nowhere."""
    bit = F.pmod("seed", F.lit(bits))
    chunks = seeds.select((bit / CHUNK).cast("int").alias("chunk"), (bit % CHUNK).cast("int").alias("bit"))
    chunks = chunks.groupBy("chunk").agg(F.collect_set("bit").alias("bits"))
    table = np.zeros(bits // 8, np.uint8)
    for row in chunks.mapInArrow(_filter_chunks, "chunk int, packed binary").toLocalIterator():
        table[row.chunk * CHUNK // 8 : (row.chunk + 1) * CHUNK // 8] = np.frombuffer(row.packed, np.uint8)
    return table


def _seeded(size: int, table, bits: int):
    """Documents with seeds that pass the filter, and those seeds."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        on = table.value
        for part in parts:
            for first, n, data, offsets in W.text_slices(part.column("text")):
                hashes, _, _, rows = W.word_hashes(data, offsets, W.ALNUM)
                at, seeds = W.window_hashes(hashes, rows, size)
                bit = (seeds & W.U(bits - 1)).astype(np.int64)
                hit = (on[bit >> 3] >> (bit & 7).astype(np.uint8) & 1).astype(bool)
                seeds, of = seeds[hit], rows[at[hit]]
                order = np.lexsort((seeds, of))
                seeds, of = seeds[order], of[order]
                new = np.ones(len(of), bool)
                new[1:] = (of[1:] != of[:-1]) | (seeds[1:] != seeds[:-1])
                counts = np.bincount(of[new], minlength=n)
                some = pa.array(np.flatnonzero(counts))
                if len(some):
                    yield pa.RecordBatch.from_arrays(
                        [part.column(c).slice(first, n).take(some) for c in ("doc", "row", "text")]
                        + [W.lists(W.signed(seeds[new]), counts[counts > 0])],
                        ["doc", "row", "text", "seeds"],
                    )

    return run


def tiles(a: np.ndarray, b: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two sequences of word hashes: (start in a, start in b, length), longest first."""
    free_a, free_b = np.ones(len(a), bool), np.ones(len(b), bool)
    out = []
    size = max(least, min(len(a), len(b)))
    while size >= least:
        found = _common(a, b, free_a, free_b, size)
        longest = max((n for _, _, n in found), default=0)
        if longest > 2 * size:
            size = longest
            continue
        # what is left of a partly taken match waits in line with the others; none of this size stays free
        line = [(-n, i, j) for i, j, n in found]
        heapify(line)
        while line:
            n, i, j = heappop(line)
            free = free_a[i : i - n] & free_b[j : j - n]
            if free.all():
                free_a[i : i - n] = free_b[j : j - n] = False
                out.append((i, j, -n))
                continue
            edges = np.flatnonzero(np.diff(np.concatenate([[0], free.view(np.int8), [0]])))
            for begin, end in edges.reshape(-1, 2).tolist():
                if end - begin >= size:
                    heappush(line, (begin - end, i + begin, j + begin))
        if size == least:
            break
        size = max(least, size // 2)
    return out


def _common(a, b, free_a, free_b, size: int) -> list[tuple[int, int, int]]:
    """Maximal free matches of at least ``size`` tokens, found by rolling hashes of that length."""
    at_a, at_b = (_free_windows(free, size) for free in (free_a, free_b))
    if not len(at_a) or not len(at_b):
        return []
    hash_a, hash_b = (W.run_hashes(x, at, at + size, W.WORD_BASE) for x, at in ((a, at_a), (b, at_b)))
    shared = np.isin(hash_b, hash_a)
    places: dict[int, list[int]] = {}
    for h, i in zip(hash_a.tolist(), at_a.tolist(), strict=True):
        places.setdefault(h, []).append(i)
    out = []
    for h, j in zip(hash_b[shared].tolist(), at_b[shared].tolist(), strict=True):
        for i in places[h]:
            if i and j and free_a[i - 1] and free_b[j - 1] and a[i - 1] == b[j - 1]:
                continue  # part of a longer match
            n = size
            while i + n < len(a) and j + n < len(b) and free_a[i + n] and free_b[j + n] and a[i + n] == b[j + n]:
                n += 1
            if (a[i : i + size] == b[j : j + size]).all():
                out.append((i, j, n))
    return out


def _free_windows(free: np.ndarray, size: int) -> np.ndarray:
    if len(free) < size:
        return np.zeros(0, np.int64)
    taken = np.concatenate([[0], np.cumsum(~free)])
    return np.flatnonzero(taken[size:] == taken[:-size])


def _tiled(size: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def hashes(text: str) -> np.ndarray:
            data = np.frombuffer(text.encode(), np.uint8)
            return W.word_hashes(data, np.array([0, len(data)]), W.ALNUM)[0]

        for part in parts:
            known: dict[str, np.ndarray] = {}
            last, of_last = None, None
            counts = []
            keys = zip(*(part.column(c).to_pylist() for c in ("doc", "row", "item_text")), strict=True)
            for k, (doc, row, item) in enumerate(keys):
                if (doc, row) != last:
                    last, of_last = (doc, row), hashes(part.column("text")[k].as_py())
                if item not in known:
                    known[item] = hashes(item)
                found = tiles(known[item], of_last, size)
                counts.append((len(known[item]), sum(n for _, _, n in found), len(found)))
            counts = np.array(counts, np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [part.column(c) for c in ("doc", "row", "item")] + [pa.array(counts[:, k]) for k in range(3)],
                ["doc", "row", "item", "n_tokens", "covered", "n_tiles"],
            )

    return run


def contaminated_pairs(
    docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, size: int, threshold: float
) -> DataFrame:
    """doc, row, item, n_tokens, covered, n_tiles for pairs whose coverage reaches the threshold."""
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item"), F.lower("text").alias("text")).filter(
        "item IS NOT NULL AND text IS NOT NULL"
    )
    seeds = materialise(items.mapInArrow(_item_seeds(size), ITEM_SEEDS), "item-seeds")
    table = spark.sparkContext.broadcast(seed_filter(seeds))
    keyed = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("doc"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("row"),
        F.lower(F.col(text_col)).alias("text"),
    )
    seeded = materialise(
        keyed.filter("text IS NOT NULL").mapInArrow(
            _seeded(size, table, FILTER_BITS), "doc long, row long, text string, seeds array<long>"
        ),
        "seeded",
    )
    shared = (
        seeded.select("doc", "row", F.explode("seeds").alias("seed"))
        .join(seeds, "seed")
        .groupBy("doc", "row", "item", "n_tokens")
        .agg(F.count_distinct("at").alias("places"))
        .filter(F.col("places") * size >= threshold * F.col("n_tokens"))  # no tiling can cover more
        .select("doc", "row", "item")
    )
    texts = seeded.select("doc", "row", "text").dropDuplicates(["doc", "row"])
    pairs = (
        shared.join(texts, ["doc", "row"])
        .join(items.select("item", F.col("text").alias("item_text")), "item")
        .select("doc", "row", "item", "text", "item_text")
    )
    tiled = pairs.mapInArrow(_tiled(size), TILED)
    return materialise(tiled.filter(F.col("covered") >= threshold * F.col("n_tokens")), "contaminated")


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 5,
    threshold: float = 0.5,
) -> DataFrame:
    """One row per document: doc, row, contaminated, n_items, item_id (covered best, then smallest), coverage.

    ``benchmark`` has item_id and text. Tokens are runs of letters, digits and non-ASCII characters, lower-cased. Tiles have
    at least ``size`` tokens; a document is contaminated if tiles cover at least ``threshold`` of the tokens of
    some item. Items of fewer than ``size`` tokens, and null ones, match nothing; null and empty texts match
    nothing. Items that repeat an id are separate texts of one item. ``doc`` is the id (null: the smallest long),
    ``row`` a hash of the text, by which ``left_clean`` finds a document again; rows that repeat both are one.
    Other columns are not read. An empty table gives no rows.
    """
    pairs = contaminated_pairs(docs, benchmark, id_col, text_col, size, threshold)
    coverage = F.col("covered") / F.col("n_tokens")
    best = pairs.groupBy("doc", "row").agg(
        F.count_distinct("item").alias("n_items"), F.min(F.struct((-coverage).alias("less"), "item")).alias("best")
    )
    every = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("doc"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("row"),
    )
    return every.join(best, ["doc", "row"], "left").select(
        "doc",
        "row",
        F.col("n_items").isNotNull().alias("contaminated"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.col("best.item").alias("item_id"),
        F.coalesce(-F.col("best.less"), F.lit(0.0)).alias("coverage"),
    )


def left_clean(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, threshold: float = 0.5
) -> DataFrame:
    """The documents, with all their columns, that are not contaminated."""
    bad = contaminated_pairs(docs, benchmark, id_col, text_col, size, threshold)
    bad = bad.select(F.col("doc").alias("__doc"), F.col("row").alias("__row")).distinct()
    keyed = docs.withColumns(
        {
            "__doc": F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)),
            "__row": F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))),
        }
    )
    return keyed.join(bad, ["__doc", "__row"], "left_anti").drop("__doc", "__row")
