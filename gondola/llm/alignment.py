"""Alignment of the tokens of two tokenizers, by windows between whitespace anchors.

A text is tokenised in full by both. Where tokens of both end and the next token of both is marked by a space, the text
is cut into windows, each a tuple of ids of the one and a tuple of ids of the other. A window's alignment depends on
these alone, so a batch of texts works it out once for each distinct pair of tuples. Inside a window, offsets
where tokens of both end cut groups, and tokens whose bytes overlap are linked.

Texts are handled in batches of bounded size. A batch keeps which pairs its documents link, and asks for the corpus-wide
counts of its distinct pairs once, instead of once for every document.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gondola.llm import words as W
from gondola.session import materialise

#: A space between characters that neither tokenizer joins across it: none is white space or the space mark
BREAK = re.compile("(?<=[^\\s▁]) (?=[^ ▁])")
SPACE_MARK = "▁"
BATCH_BYTES = 1 << 22
#: Chunks longer than this are not remembered
LONG = 64
#: Fixed value: the words that byte-level vocabularies merge in
BYTE_LEVEL_WORDS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: itself if visible, else the next one from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Tokenizers:
    """Ids by both tokenizers, as bytes of unsigned 32-bit numbers.

    The chunks of texts between spaces that neither tokenizer joins across are encoded once as long as they are
    remembered: when ``most`` are known, those not met since the table was last full are forgotten.
    """

    def __init__(self, byte_path: str, piece_path: str, most: int = 250_000) -> None:
        from sentencepiece import SentencePieceProcessor

        self.b = SentencePieceProcessor(model_file=piece_path)
        self.ids_a, of_a = byte_level(byte_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        of_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE_MARK, " ").encode() for i, p in enumerate(pieces)]
        self.bytes = (of_a, of_b)
        self.sizes = tuple(np.array([len(x) for x in t], np.int64) for t in self.bytes)
        self.marked = tuple(np.array([x.startswith(b" ") for x in t]) for t in self.bytes)
        #: ids as text, by what follows them inside a run and behind it
        self.told = tuple(np.array([[f"{i},", f"{i}{end}"] for i in range(len(t))], object) for t, end in zip(self.bytes, "|;", strict=True))
        #: no piece goes on behind a space mark that follows other characters, so no piece crosses a BREAK
        self.breaks = not any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in pieces)
        self.most, self.known, self.older, self.changed = most, {}, {}, set()

    def learn(self, chunks: list[str], known: dict[str, tuple[bytes, bytes]]) -> None:
        """Ids of a space and each chunk by A and by B. Chunks whose tokens of A or B are not its bytes are put in ``changed``."""
        sides = [list(map(self.ids_a, [" " + c for c in chunks])), self.b.encode(chunks, num_threads=1)]
        want = "".join([" " + c for c in chunks]).encode()
        packed = []
        for found, of in zip(sides, self.bytes, strict=True):
            flat = array("I", chain.from_iterable(found))
            if b"".join([of[i] for i in flat]) != want:
                self.changed.update(c for c, x in zip(chunks, found, strict=True) if b"".join([of[i] for i in x]) != (" " + c).encode())
            flat, ends = flat.tobytes(), list(accumulate(4 * len(x) for x in found))
            packed.append([flat[i:j] for i, j in zip([0, *ends], ends, strict=False)])
        known.update(zip(chunks, zip(*packed, strict=True), strict=True))

    def __call__(self, texts: list[str]) -> Iterator[tuple[bytes, bytes] | None]:
        """Of each text; None for empty texts and for those that one tokenizer changes."""
        parts = [(BREAK.split(t) if self.breaks else [t]) if t else [] for t in texts]
        wanted = set().union(*parts)
        new = wanted.difference(self.known)
        if len(self.known) + len(new) > self.most:
            self.known, self.older, new = {}, {c: x for c, x in self.known.items() if c not in self.changed}, wanted
            self.changed = set()
        met = new & self.older.keys()
        self.known.update((c, self.older[c]) for c in met)
        new -= met
        long = [c for c in new if len(c) > LONG]
        self.learn(list(new.difference(long)), self.known)
        known = self.known
        if long:
            known = known.copy()
            self.learn(long, known)
        for p in parts:
            if not p or not self.changed.isdisjoint(p):
                yield None
            else:
                a, b = zip(*[known[c] for c in p], strict=True)
                yield b"".join(a), b"".join(b)
        self.changed.difference_update(long)


def byte_level(path: str) -> tuple[Callable[[str], list[int]], list[bytes]]:
    """Encoder and tokens of a byte-level vocabulary.

    Where ids follow the order of merges, merging by the lowest id is the same, and a library that only does that is faster.
    """
    from tiktoken import Encoding

    with open(path, encoding="utf-8") as file:
        held = json.load(file)
    letters, model = byte_letters(), held["model"]
    merges = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    added = {x["id"] for x in held["added_tokens"]}
    of = {i: bytes(letters[c] for c in t) for t, i in model["vocab"].items() if i not in added}
    tokens = [of.get(i, b"") for i in range(max([*of, *added]) + 1)]
    plain = held["normalizer"] is None and held["pre_tokenizer"] == {
        "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True,
    }
    if plain and [model["vocab"][m] for m in merges] == list(range(256, 256 + len(merges))) and len(set(of.values())) == len(of):
        found = Encoding("byte-level", pat_str=BYTE_LEVEL_WORDS, mergeable_ranks={b: i for i, b in of.items()}, special_tokens={})
        return found.encode_ordinary, tokens
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True  # their strings are plain text
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids, tokens


@lru_cache(1)
def tokenizers(byte_path: str, piece_path: str) -> Tokenizers:
    """One for each Python worker, which serves many tasks."""
    return Tokenizers(byte_path, piece_path)


def windows(ids: tuple[np.ndarray, np.ndarray], t: Tokenizers) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Where windows end, in bytes, and for each tokenizer their first tokens and those behind their last."""
    ends = [np.cumsum(t.sizes[k][ids[k]]) for k in (0, 1)]
    total = int(ends[0][-1])
    anchor = np.ones(total + 1, bool)
    for k in (0, 1):
        ended, begun = np.zeros((2, total + 1), bool)
        ended[ends[k]] = True
        begun[ends[k][:-1]] = t.marked[k][ids[k][1:]]
        begun[total] = True
        anchor &= ended & begun
    held = []
    for k in (0, 1):
        behind = np.flatnonzero(anchor[ends[k]]) + 1
        held.append((np.append(0, behind[:-1]), behind))
    return np.flatnonzero(anchor), held


def distinct_windows(ids: tuple[np.ndarray, np.ndarray], held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """First windows of each kind, and the kind of every window: found by hash, then compared."""
    codes = [W.run_hashes(ids[k] + np.uint32(1), *held[k], base) for k, base in ((0, W.WORD_BASE), (1, W.OTHER_BASE))]
    _, first, kind = np.unique(W.mixed(codes[0] + W.U(0x9E3779B97F4A7C15)) ^ codes[1], return_index=True, return_inverse=True)
    for k in (0, 1):
        low, high = held[k]
        like = first[kind]
        same = np.array_equal(high - low, high[like] - low[like])
        if same:
            shift = np.repeat(low[like] - low, high - low)
            same = np.array_equal(ids[k][np.arange(len(ids[k])) + shift], ids[k])
        if not same:  # two kinds with one hash
            raise ArithmeticError("two windows have one hash")
    return first, kind


def align_ids(ids: tuple[np.ndarray, np.ndarray], t: Tokenizers) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
    """Of two token sequences over the same bytes: where A's groups end, each link as a << 32 | b and its A token, and
    the ids group by group as text, A's before B's, with what stands between them.

    Every stretch between two neighbouring ends, of either side, is what one token of A and one of B have in common.
    """
    ends = [np.cumsum(t.sizes[k][ids[k]]) for k in (0, 1)]
    ended = np.zeros((2, int(ends[0][-1]) + 1), bool)
    for k in (0, 1):
        ended[k, ends[k]] = True
    stretch = np.flatnonzero(ended[0] | ended[1])
    token = [np.cumsum(ended[k], dtype=np.int64)[stretch] - ended[k, stretch] for k in (0, 1)]
    links = ids[0][token[0]].astype(np.int64) << 32 | ids[1][token[1]]
    last = [ended[1 - k, ends[k]] for k in (0, 1)]  # of a group
    group = [np.cumsum(last[k]) - last[k] for k in (0, 1)]
    size = [np.bincount(group[k]) for k in (0, 1)]
    told = np.empty(len(ids[0]) + len(ids[1]), object)
    told[np.arange(len(ids[0])) + (np.cumsum(size[1]) - size[1])[group[0]]] = t.told[0][ids[0], last[0].astype(int)]
    told[np.arange(len(ids[1])) + np.cumsum(size[0])[group[1]]] = t.told[1][ids[1], last[1].astype(int)]
    return last[0], links, token[0], told.tolist()


def gathered(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The runs values[low:high], one after another."""
    size = high - low
    return values[np.arange(int(size.sum())) + np.repeat(low - (np.cumsum(size) - size), size)]


def align_kinds(ids: tuple[np.ndarray, np.ndarray], held: list[tuple[np.ndarray, np.ndarray]], first: np.ndarray, t: Tokenizers):
    """Of each distinct window: number of groups, number of links, the links, and its groups as text."""
    runs = [(held[k][0][first], held[k][1][first]) for k in (0, 1)]
    last, links, token, told = align_ids(tuple(gathered(ids[k], *runs[k]) for k in (0, 1)), t)
    size = [high - low for low, high in runs]
    kind = np.repeat(np.arange(len(first)), size[0])  # of A's tokens
    n_groups = np.bincount(kind[last], minlength=len(first))
    n_links = np.bincount(kind[token], minlength=len(first))
    ends = np.cumsum(size[0] + size[1]).tolist()
    return n_groups, n_links, links, ["".join(told[a:b]) for a, b in zip([0, *ends], ends, strict=False)]


def align_batch(found: list[tuple[bytes, bytes] | None], t: Tokenizers, with_groups: bool = False) -> dict[str, pa.Array | np.ndarray]:
    """Columns of the texts of a batch, and the batch's distinct pairs with the number of its texts that link them."""
    n = len(found)
    valid = np.array([k for k, x in enumerate(found) if x], np.int64)
    counts, sums = np.zeros((2, n), np.int64), np.zeros((2, n), np.int64)
    told = [""] * n
    pairs, pair_docs, pair, times = (np.zeros(0, np.int64) for _ in range(4))
    n_pairs = np.zeros(n, np.int64)
    if len(valid):
        ids = tuple(np.frombuffer(b"".join([found[k][side] for k in valid]), np.uint32) for side in (0, 1))
        for side in (0, 1):
            counts[side, valid] = [len(found[k][side]) // 4 for k in valid]
        cuts, held = windows(ids, t)
        text_ends = np.cumsum(t.sizes[0][ids[0]])[np.cumsum(counts[0, valid]) - 1]
        upto = np.searchsorted(cuts, text_ends, "right")  # windows up to the end of each text
        doc = np.repeat(valid, np.diff(upto, prepend=0))
        first, kind = distinct_windows(ids, held)
        n_groups, n_links, links, texts = align_kinds(ids, held, first, t)
        sums = [np.bincount(doc, x[kind], n).astype(np.int64) for x in (n_groups, n_links)]
        texts = np.array(texts, object)[kind].tolist()
        for k, low, high in zip(valid.tolist(), [0, *upto[:-1].tolist()], upto.tolist(), strict=True):
            told[k] = "".join(texts[low:high])[:-1]
        # a text's pairs: those of its distinct windows, as often as these occur
        pairs, of_link = np.unique(links, return_inverse=True)
        both, often = np.unique(doc * len(first) + kind, return_counts=True)
        of, which = np.divmod(both, len(first))
        high = np.cumsum(n_links)[which]
        size = n_links[which]
        both = np.repeat(of, size) * len(pairs) + gathered(of_link, high - size, high)
        order = np.argsort(both)
        both = both[order]
        new = np.flatnonzero(np.diff(both, prepend=-1))
        times = np.add.reduceat(np.repeat(often, size)[order], new)
        of, pair = np.divmod(both[new], len(pairs))
        n_pairs = np.bincount(of, minlength=n)
        pair_docs = np.bincount(pair, minlength=len(pairs))
    out = {
        "n_a": pa.array(counts[0]),
        "n_b": pa.array(counts[1]),
        "n_groups": pa.array(sums[0]),
        "n_links": pa.array(sums[1]),
        "groups_sha256": pa.array([hashlib.sha256(x.encode()).hexdigest() if x else "" for x in told], pa.string()),
        "pair": W.lists(pa.array(pair.astype(np.int32)), n_pairs),
        "times": W.lists(pa.array(times.astype(np.int32)), n_pairs),
        "pairs": pairs,
        "pair_docs": pair_docs,
    }
    return out | ({"groups": pa.array(told, pa.string())} if with_groups else {})


FOUND = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
STORED = f"batch long, {FOUND}, pair array<int>, times array<int>, pairs array<long>, pair_docs array<long>"


def _aligned(byte_path: str, piece_path: str, with_groups: bool):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizers(byte_path, piece_path)
        batch = TaskContext.get().partitionId() << 32
        for part in parts:
            ids = part.column("doc_id")
            for first, n, _, _ in W.text_slices(part.column("text"), BATCH_BYTES):
                texts = [x or "" for x in part.column("text").slice(first, n).to_pylist()]
                out = align_batch(list(t(texts)), t, with_groups)
                pairs, docs = out.pop("pairs"), out.pop("pair_docs")
                none = lambda kind, size=n: pa.nulls(size, kind)
                rows = {"batch": pa.array(np.full(n, batch)), "doc_id": ids.slice(first, n)} | out
                longs = pa.list_(pa.int64())
                rows |= {"pairs": none(longs), "pair_docs": none(longs)}
                yield pa.RecordBatch.from_pydict(rows)
                own = {c: none(v.type, 1) for c, v in rows.items()}
                own |= {"batch": pa.array([batch]), "pairs": pa.array([pairs], longs), "pair_docs": pa.array([docs], longs)}
                yield pa.RecordBatch.from_pydict(own)
                batch += 1

    return run


def _summed(names: list[str]):
    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        value = np.zeros(answers.num_rows, np.int64)
        value[answers.column("place").to_numpy()] = answers.column("value").to_numpy()
        texts = texts.combine_chunks()
        pair, times = (texts.column(c).combine_chunks() for c in ("pair", "times"))
        row = np.repeat(np.arange(texts.num_rows), pair.value_lengths().to_numpy())
        value, times = value[pair.flatten().to_numpy()], times.flatten().to_numpy().astype(np.int64)
        sums = np.zeros((2, texts.num_rows), np.int64)
        np.add.at(sums[0], row, (value & 1) * times)
        np.add.at(sums[1], row, (value >> 1) * times)
        columns = [texts.column(c) for c in names] + [pa.array(s) for s in sums]
        return pa.Table.from_arrays(columns, [*names, "n_best", "count_sum"])

    return run


def align(
    docs: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text", with_groups: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Documents and linked id pairs.

    Documents: doc_id (long), n_a, n_b (tokens), n_groups, n_links, n_best, count_sum, groups_sha256, and with ``with_groups``
    groups, as ``a1,a2|b1;a3|b2,b3``. Tokenizer A is the byte-level file at ``byte_path``, applied to a space and the text, B
    the piece model at ``piece_path``, which adds that space itself. ``n_links`` are the pairs of token occurrences
    whose bytes overlap, ``count_sum`` sums over them how many documents link the pair's ids, and ``n_best`` are those whose
    ids no other pair of the same A id exceeds in that number. Pairs: a_id, b_id, n_docs, is_best.

    A null or empty text, and one whose tokens of A or B are not its bytes (a U+2581 in it), has zeros and an empty
    ``groups_sha256``. Rows that repeat an id, or have none, are documents of their own. Other columns are not read. An
    empty table gives no rows. Memory follows the longest text, some forty bytes for each of its own.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = STORED + (", groups string" if with_groups else "")
    schema_order = [c.split()[0] for c in schema.split(", ")]
    stored = rows.mapInArrow(_aligned(byte_path, piece_path, with_groups), _in_order(schema, with_groups))
    stored = materialise(stored.select(*schema_order), "aligned")
    asked = stored.filter("pairs IS NOT NULL").select("batch", F.posexplode(F.arrays_zip("pairs", "pair_docs")).alias("place", "of"))
    asked = asked.select("batch", "place", F.col("of.pairs").alias("code"), F.col("of.pair_docs").alias("n"))
    counts = materialise(asked.groupBy("code").agg(F.sum("n").alias("n_docs")).withColumn("a_id", F.shiftright("code", 32)), "counts")
    best = materialise(counts.groupBy("a_id").agg(F.max("n_docs").alias("best")), "best")
    is_best = F.col("n_docs") == F.col("best")
    rated = materialise(counts.join(best, "a_id").select("code", "a_id", "n_docs", is_best.alias("is_best")), "rated")
    value = (F.col("n_docs") * 2 + F.col("is_best").cast("long")).alias("value")
    answers = asked.join(rated, "code").select(F.col("batch").alias("of_batch"), "place", value)
    names = [c.split()[0] for c in FOUND.split(", ")] + ["groups"] * with_groups
    found = (
        stored.filter("pairs IS NULL")
        .groupBy("batch")
        .cogroup(answers.groupBy("of_batch"))
        .applyInArrow(_summed(names), f"{FOUND}{', groups string' if with_groups else ''}, n_best long, count_sum long")
    )
    low = F.col("code").bitwiseAND(F.lit((1 << 32) - 1))
    return found, rated.select("a_id", low.alias("b_id"), "n_docs", "is_best")


def _in_order(schema: str, with_groups: bool) -> str:
    """Columns in the order in which batches have them."""
    kinds = dict(c.split(" ", 1) for c in schema.split(", "))
    names = ["batch", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pair", "times"]
    names += ["groups"] * with_groups + ["pairs", "pair_docs"]
    return ", ".join(f"{c} {kinds[c]}" for c in names)
