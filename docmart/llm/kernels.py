"""Vectorised text kernels used inside Spark tasks.

A task sees Arrow batches of (id, text).  :func:`slices` cuts a batch into runs
of whole documents of about ``SLICE_BYTES`` so that the working arrays stay
small whatever the batch holds; everything below works on one slice with numpy.
Texts are UTF-8 bytes throughout, so no Python string is made per document.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
#: Odd multiplier of the polynomial hashes, and the two byte tables behind them.
RADIX = np.uint64(0x9E3779B97F4A7C15)
_RADIX_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
BYTE_CODES = np.random.Generator(np.random.PCG64(20240901)).integers(1, 1 << 63, size=(2, 256), dtype=np.uint64) | np.uint64(1)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def byte_class(spec: Iterable[tuple[int, int]]) -> np.ndarray:
    """A table of 256 booleans that is true on the given inclusive byte ranges."""
    out = np.zeros(256, bool)
    for lo, hi in spec:
        out[lo : hi + 1] = True
    return out


#: Words as runs of letters, digits and all non-ASCII characters (``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing).
PLAIN_WORD = byte_class([(0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)])
#: Words as runs between ASCII white space (``[^\x20\x09-\x0D]+``).
SPACED_WORD = ~byte_class([(0x20, 0x20), (0x09, 0x0D)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of the multiplier and of its inverse, modulo 2**64."""
    if len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + 256)
        for k, base in enumerate((RADIX, _RADIX_INV)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[k] = np.cumprod(p)
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that all bits depend on all bits."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(32)
    return x


def prefix(codes: np.ndarray) -> np.ndarray:
    """Prefix sums of codes times powers; hashes of ranges come from differences."""
    p, _ = powers(len(codes))
    out = np.empty(len(codes) + 1, np.uint64)
    out[0] = 0
    np.cumsum(codes * p, out=out[1:])
    return out


def ranges(pre: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Mixed hashes of the code ranges [a, b); equal ranges hash equally wherever they stand."""
    _, inv = powers(len(pre))
    return mix((pre[b] - pre[a]) * inv[a] + (b - a).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def rolling(pre: np.ndarray, width: int) -> np.ndarray:
    """Mixed hashes of all ranges of one width."""
    n = len(pre) - width
    if n <= 0:
        return np.empty(0, np.uint64)
    _, inv = powers(n)
    return mix((pre[width:] - pre[:n]) * inv)


@dataclass
class Slice:
    """Whole documents as adjoining bytes: document i is data[starts[i]:ends[i]]; rows are their places in the batch."""

    rows: np.ndarray
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    def words(self, table: np.ndarray, lower: bool = False) -> Words:
        raw = LOWER[self.data] if lower else self.data
        return Words(self, raw, *word_bounds(raw, self.starts, self.ends, table))


@dataclass
class Words:
    """Words of a slice: byte bounds, and the document (within the slice) of each."""

    of: Slice
    raw: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray

    def hashes(self, table: int = 0) -> np.ndarray:
        return ranges(prefix(BYTE_CODES[table][self.raw]), self.start, self.end)

    def first(self) -> np.ndarray:
        """Index of each document's first word, and the number of words at the end."""
        return np.searchsorted(self.doc, np.arange(len(self.of.rows) + 1))


def word_bounds(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = len(raw)
    inside = np.zeros(n + 1, bool)
    inside[:n] = table[raw]
    before = np.zeros(n + 1, bool)
    before[1:] = inside[:n]
    before[starts] = False
    start = np.flatnonzero(inside[:n] & ~before[:n])
    after = np.zeros(n, bool)
    after[: n - 1 if n else 0] = inside[1:n]
    full = ends[ends > starts] - 1
    after[full] = False
    end = np.flatnonzero(inside[:n] & ~after) + 1
    doc = np.searchsorted(starts, start, side="right") - 1
    return start, end, doc


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string array; nulls count as empty."""
    if column.null_count:
        column = column.fill_null("")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    return offsets, np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """Cut a text column into slices of whole documents, of ``limit`` bytes or a single document."""
    offsets, data = text_buffers(column)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        lo = offsets[i]
        own = offsets[i : j + 1] - lo
        yield Slice(np.arange(i, j), data[lo : offsets[j]], own[:-1], own[1:])
        i = j


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values, by doubling."""
    out, have = x, 1
    while have * 2 <= width:
        out = np.minimum(out[: len(out) - have], out[have:])
        have *= 2
    if have < width and len(out) > width - have:
        out = np.minimum(out[: len(out) - (width - have)], out[width - have :])
    elif have < width:
        out = out[:0]
    return out


def covered(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of n places lie in any of the ranges [a, b)."""
    delta = np.zeros(n + 1, np.int64)
    np.add.at(delta, a, 1)
    np.add.at(delta, b, -1)
    return np.cumsum(delta[:n]) > 0


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds [a, b) of the maximal true runs."""
    edge = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
