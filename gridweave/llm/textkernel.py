"""Vectorised text kernels: many documents are cut into words and hashed by a few numpy passes.

Texts of an Arrow batch are handled in slices of a few MB, so working memory is bounded by the
slice (or by the longest single text). A word is a maximal run of bytes outside
``\\x20 \\x09-\\x0D``; the delimiters are ASCII, so UTF-8 sequences are never cut.

Hashes are sums of character codes times multipliers of their places, both random 64-bit numbers: unlike powers of
one base, the multipliers have no structure that texts could repeat. Operators that need words told apart for certain
(the tokenisers) compare the words of equal hashes.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_NORMAL = _LOWER.copy()
_NORMAL[48:58] = 48
_IDENTITY = np.arange(256, dtype=np.uint8)


def _give_back() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidy(run: Callable) -> Callable:
    """``run`` (a function over Arrow batches) that gives free memory back to the system when it ends: Python workers are
    used again, and what one stage needed at most would otherwise stay with its executor."""

    @functools.wraps(run)
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            _give_back()

    return wrapped


def tidy_group(run: Callable) -> Callable:
    """The same for a function of a key and its batches."""

    @functools.wraps(run)
    def wrapped(key, batches):
        try:
            yield from run(key, batches)
        finally:
            _give_back()

    return wrapped


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def random_table(size: int, seed: int) -> np.ndarray:
    return mix(np.arange(1, size + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


_BYTE_CODE = random_table(256, 11)
_multipliers: dict[int, np.ndarray] = {}


def multipliers(n: int, seed: int = 0) -> np.ndarray:
    """A random number for each of the first ``n`` places, at least; other seeds give other numbers."""
    known = _multipliers.get(seed)
    if known is None or len(known) < n:
        known = _multipliers[seed] = random_table(max(1024, 2 * n), 0xA24BAED4963EE407 + seed)
    return known


def ranges(lens: np.ndarray) -> np.ndarray:
    """0..n-1 for each n of lens, one after the other."""
    if not len(lens):
        return np.zeros(0, np.int64)
    ends = np.cumsum(lens)
    return np.arange(ends[-1], dtype=np.int64) - np.repeat(ends - lens, lens)


def run_hashes(codes: np.ndarray, lens: np.ndarray, seed: int = 0) -> np.ndarray:
    """A hash for each run of ``codes``; runs lie one after the other and none is empty."""
    if not len(lens):
        return np.zeros(0, np.uint64)
    ends = np.cumsum(lens)
    terms = codes * multipliers(int(lens.max()), seed)[ranges(lens)]
    return mix(np.add.reduceat(terms, ends - lens) + lens.astype(np.uint64))


def string_buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and n + 1 offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(data: np.ndarray, offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows with up to ``most`` bytes, one row at least."""
    n, at = len(offsets) - 1, 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, end, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


class Words:
    """The words of a slice: byte positions, lengths, and for each document its range of words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        inside = ~_SPACE[data]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        begins = offsets[:-1][offsets[:-1] < len(data)]
        first[begins] = inside[begins]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        ends = offsets[1:][offsets[1:] > 0] - 1
        last[ends] = inside[ends]
        self.inside = inside
        self.starts = np.flatnonzero(first)
        self.lens = np.flatnonzero(last) + 1 - self.starts
        self.of_doc = np.searchsorted(self.starts, offsets)

    def hashes(self, fold: str = "none") -> np.ndarray:
        """fold: "none", "lower" (A-Z), or "normal" (A-Z, and every digit counts as 0)."""
        table = {"none": _IDENTITY, "lower": _LOWER, "normal": _NORMAL}[fold]
        return run_hashes(_BYTE_CODE[table][self.data[self.inside]], self.lens)


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash for each run of ``width`` consecutive entries, at its first entry; runs across documents
    are for the caller to leave out."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out += hashes[k : k + n] * multipliers(width)[k]
    return mix(out + np.uint64(width))


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def batches_out(schema: pa.Schema, columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if not isinstance(columns[f.name], pa.Array) else columns[f.name].cast(f.type) for f in schema], schema=schema)
