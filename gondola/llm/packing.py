"""Best-fit packing of token sequences, by partitions first and then up a tree.

Every partition packs its own pieces best-fit. Bins that are full but for a few tokens are
done. The others, as items of their own, meet those of other partitions in fewer, larger groups and
are packed again, until a group would be larger than one task should hold. No task ever sees more
than its group, and only underfull bins move.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gondola.llm import words as W
from gondola.session import materialise

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
FIELDS = ["doc_id", "piece", "start", "length", "ids_crc32"]
ARROW_PIECE = pa.struct([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
BIN = f"sequence_id long, fill long, done boolean, pieces array<struct<{PIECE.replace(' ', ':').replace(',:', ',')}>>"


#: Latin letters that composition leaves alone and lower-case one by one, and marks that never join letters
SIMPLE = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+)([.,!?;:*#%$&|()]*)")


class Known(dict):
    """Ids of chunks, looked for by ``find`` when first asked for."""

    def __init__(self, find: Callable[[str], bytes]) -> None:
        self.find = find

    def __missing__(self, chunk: str) -> bytes:
        ids = self[chunk] = self.find(chunk)
        return ids


class ChunkTokens:
    """Ids of whole texts, from the ids of their space-separated chunks, as little-endian bytes.

    The tokenizer drops white space and never joins across it, nor does it join letters with the marks of
    SIMPLE, so a text's ids are those of its parts in order. Each part is encoded once as long as it is
    remembered: when ``most`` chunks are known, those not met since the table was last full are forgotten.
    """

    def __init__(self, path: str, most: int = 250_000) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer, self.most = Tokenizer.from_file(path), most
        self.model = self.tokenizer.model
        self.known, self.older = Known(self.find), {}
        self.words, self.marks = Known(self.word), Known(self.encoded)
        byte_level = ByteLevel(add_prefix_space=False, use_regex=False)
        letters = (chr(c) for c in range(0x80, 0x250))
        self.bytes_of = {ord(c): byte_level.pre_tokenize_str(c)[0][0] for c in letters if SIMPLE.fullmatch(c)}

    def encoded(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def word(self, text: str) -> bytes:
        """Of a lower-case word of letters, straight from the merges."""
        text = text if text.isascii() else text.translate(self.bytes_of)
        return array("I", [t.id for t in self.model.tokenize(text)]).tobytes()

    def find(self, chunk: str) -> bytes:
        """Of a chunk that is not known: from the older ones, or by its word and the marks behind it."""
        ids = self.older.get(chunk)
        if ids is not None:
            return ids
        if chunk.isascii() and chunk.isalpha():
            word, mark = chunk.lower(), ""
        else:
            m = SIMPLE.fullmatch(chunk)
            if m is None:
                return self.encoded(chunk)
            word, mark = m[1].lower(), m[2]
        if word == chunk:
            return self.word(word)
        # written otherwise than it is read: the plain word may be known, and may be written in other ways still
        ids = self.known.get(word) or self.older.get(word) or self.words[word]
        return ids + self.marks[mark] if mark else ids

    def __call__(self, texts: list[str]) -> Iterator[np.ndarray]:
        if len(self.known) + len(self.words) > self.most:
            self.known, self.older = Known(self.find), self.known
            self.words.clear()
            self.marks.clear()
        ids_of = self.known.__getitem__
        for t in texts:
            parts = t.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
            yield np.frombuffer(b"".join(map(ids_of, parts)), "<u4")


@lru_cache(1)
def chunk_tokens(path: str) -> ChunkTokens:
    """One for each Python worker, which serves many tasks."""
    return ChunkTokens(path)


def _pieces(path: str, capacity: int, end_id: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = chunk_tokens(path)
        for part in parts:
            ids = part.column("doc_id").to_pylist()
            for first in range(0, len(ids), 256):
                rows = []
                texts = [t or "" for t in part.column("text").slice(first, 256).to_pylist()]
                for doc, found in zip(ids[first : first + 256], tokens(texts), strict=True):
                    found = np.append(found, np.uint32(end_id)).astype("<u4", copy=False)
                    for k, start in enumerate(range(0, len(found), capacity)):
                        piece = found[start : start + capacity]
                        rows.append((doc, k, start, len(piece), zlib.crc32(piece.tobytes())))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), ARROW_PIECE, strict=True)], FIELDS
                )

    return run


def best_fit(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The bin of each item, longest items first, each to the open bin it fills best."""
    order = np.argsort(-sizes, kind="stable")
    bins = np.empty(len(sizes), np.int64)
    room: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by the room they have
    mask, made = 0, 0  # bit r: a bin with room r
    for i, size in zip(order.tolist(), sizes[order].tolist(), strict=True):
        fits = mask >> size
        if fits:
            r = size + (fits & -fits).bit_length() - 1
            b = room[r].pop()
            if not room[r]:
                mask ^= 1 << r
        else:
            r, b, made = capacity, made, made + 1
        bins[i] = b
        if r > size:
            if not room[r - size]:
                mask |= 1 << (r - size)
            room[r - size].append(b)
    return bins


def _packed(capacity: int, slack: int, round_no: int, last: bool, group: int):
    def packed(table: pa.Table, first_id: int) -> Iterator[pa.RecordBatch]:
        table = table.combine_chunks()
        sizes = table.column("fill").to_numpy()
        pieces = table.column("pieces").chunk(0)
        bins = best_fit(sizes, capacity)
        order = np.argsort(bins, kind="stable")
        fill = np.bincount(bins, sizes).astype(np.int64)
        counts = np.bincount(bins, pieces.value_lengths().to_numpy()).astype(np.int64)
        flat = pieces.take(pa.array(order)).flatten()
        done = np.full(len(fill), last) | (fill >= capacity - slack)
        ends = np.cumsum(counts)
        for a in range(0, len(fill), 4096):
            z = min(a + 4096, len(fill))
            low = ends[a] - counts[a]
            held = W.lists(flat.slice(low, ends[z - 1] - low), counts[a:z])
            yield pa.RecordBatch.from_arrays(
                [pa.array(first_id + np.arange(a, z)), pa.array(fill[a:z]), pa.array(done[a:z]), held],
                ["sequence_id", "fill", "done", "pieces"],
            )

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        next_id = (round_no << 56) + (TaskContext.get().partitionId() << 32)
        held, n = [], 0
        for part in parts:
            held.append(part)
            n += part.num_rows
            if n >= group:
                for out in packed(pa.Table.from_batches(held), next_id):
                    next_id += out.num_rows
                    yield out
                held, n = [], 0
        if n:
            yield from packed(pa.Table.from_batches(held), next_id)

    return run


def _placed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each piece, with its place in its bin."""
    for part in parts:
        pieces = part.column("pieces")
        counts = pieces.value_lengths().to_numpy()
        flat = pieces.flatten()
        lengths = flat.field("length").to_numpy()
        before = np.cumsum(lengths) - lengths
        firsts = np.cumsum(counts) - counts
        offset = before - np.repeat(before[firsts[counts > 0]], counts[counts > 0])
        ids = np.repeat(part.column("sequence_id").to_numpy(), counts)
        if len(flat):
            yield pa.RecordBatch.from_arrays([*flat.flatten(), pa.array(ids), pa.array(offset)], [*FIELDS, "sequence_id", "offset"])


def token_pieces(
    docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of at most ``capacity`` ids; ``end_id`` closes a text."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_pieces(path, capacity, end_id), PIECE)


def pack(
    docs: DataFrame,
    path: str,
    capacity: int = 2048,
    end_id: int = 0,
    slack: int = 4,
    fan_in: int = 8,
    group: int = 100_000,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A text is its ids by the tokenizer file at ``path``, then ``end_id``; null and empty texts are ``end_id``
    alone. Only longer texts are cut. Bins with at most ``slack`` free tokens are done; the others are
    packed again, ``fan_in`` partitions at a time, until groups hold some ``group`` bins. Ids may be null or
    repeat: every row is packed as a document of its own. Other columns are not read. An empty table gives no rows.
    """
    pieces = materialise(token_pieces(docs, path, capacity, end_id, id_col, text_col), "pieces")
    items = pieces.select(F.col("length").alias("fill"), F.array(F.struct(*FIELDS)).alias("pieces"))
    parts, finished, round_no = items.rdd.getNumPartitions(), [], 0
    while True:
        last = parts <= 1
        bins = materialise(items.mapInArrow(_packed(capacity, slack, round_no, last, group), BIN), f"bins-{round_no}")
        finished.append(bins.filter("done"))
        if last:
            break
        rest = bins.filter("NOT done")
        open_bins = rest.count()
        least = -(-open_bins // group)
        fewer = max(1, least, -(-parts // fan_in))
        if fewer >= parts:  # groups are as large as they may be: what is open now stays as it is
            finished.append(rest)
            break
        items, parts, round_no = rest.select("fill", "pieces").repartition(fewer), fewer, round_no + 1
    packed = finished[0]
    for more in finished[1:]:
        packed = packed.unionByName(more)
    return packed.select("sequence_id", "pieces").mapInArrow(_placed, f"{PIECE}, sequence_id long, offset long")
