"""Words, lines and their hashes, computed for many texts at once over Arrow's byte buffers.

Texts are handled in slices of about a megabyte, so that memory does not grow with the batch;
a longer text makes a slice of its own. Hashes are polynomials modulo 2**64, finished by a mixer,
so the hash of any run of bytes or words comes from two prefix sums.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
SLICE_BYTES = 1 << 20
#: [\x20\x09-\x0D]
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
NOT_WHITE = ~WHITE
#: ASCII letters and digits, and every byte of longer UTF-8 sequences
ALNUM = np.zeros(256, bool)
for _a, _b in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
    ALNUM[_a:_b] = True
#: odd multipliers of the polynomials: of bytes, and two of words
BYTE_BASE, WORD_BASE, OTHER_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F


class Powers:
    """Powers of a base and of its inverse, modulo 2**64, grown as needed."""

    def __init__(self, base: int) -> None:
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, U)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            self.up, self.down = (
                np.cumprod(np.concatenate([np.ones(1, U), np.full(size - 1, b, U)])) for b in (self.base, self.inverse)
            )
        return self.up[:n], self.down[:n]


_powers = {b: Powers(b) for b in (BYTE_BASE, WORD_BASE, OTHER_BASE)}


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mixer of 64-bit values."""
    x = x ^ (x >> U(33))
    x = x * U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U(33))
    x = x * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = BYTE_BASE) -> np.ndarray:
    """The hash of values[s:e] for each s, e. Values must not be zero for runs of unlike length to differ."""
    up, down = _powers[base].upto(len(values) + 1)
    sums = np.zeros(len(values) + 1, U)
    np.cumsum(values.astype(U) * up[:-1], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts])


def text_slices(texts: pa.Array, size: int = SLICE_BYTES, rows: int = 1 << 16) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First row, number of rows, bytes, and the rows' offsets in them (one more than rows). Null reads as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        end = min(at + rows, max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1))
        yield at, end - at, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def spans(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray = NOT_WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the maximal runs of bytes of a kind; runs end with their row."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = kind[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | edge))
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def word_hashes(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray = NOT_WHITE):
    """Hash, start, end and row of each word."""
    starts, ends, rows = spans(data, offsets, kind)
    return run_hashes(data.astype(U) + U(1), starts, ends), starts, ends, rows


def window_hashes(hashes: np.ndarray, rows: np.ndarray, size: int, base: int = WORD_BASE) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of each window of so many words within one row."""
    at = np.arange(max(0, len(hashes) - size + 1))
    at = at[rows[at] == rows[at + size - 1]]
    return at, run_hashes(hashes, at, at + size, base)


def signed(x: np.ndarray) -> pa.Array:
    """As Spark's bigint."""
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def lists(values: pa.Array, counts: np.ndarray) -> pa.ListArray:
    """One list for each count, of consecutive values."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def batches(tables: Iterable[dict[str, pa.Array]]) -> Iterator[pa.RecordBatch]:
    """Record batches of columns, empty ones left out."""
    for t in tables:
        batch = pa.RecordBatch.from_pydict(t)
        if batch.num_rows:
            yield batch
