"""Words of UTF-8 text held in Arrow buffers, found and fingerprinted with numpy.

All word definitions used here are sets of bytes: every byte of a multi-byte character belongs to a word, so texts
never have to be decoded. A word's identity is a 64-bit fingerprint that is never 0; 0 separates texts.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 21
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
NOT_SPACE = ~SPACE
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True


def _powers(base: int, n: int) -> np.ndarray:
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        size = max(n, SLICE_BYTES + 1)
        step = np.full(size, base, dtype=np.uint64)
        step[0] = 1
        known = _POWERS[base] = np.cumprod(step, dtype=np.uint64)
        if size > 2 * SLICE_BYTES:  # one very long text; not kept for the rest of the worker's life
            del _POWERS[base]
    return known


def tidy(run: Callable) -> Callable:
    """``run`` over a task's batches, returning freed memory to the system in the end. Workers serve many tasks, and what
    an earlier one has left would count beside what the next one needs."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return tidied


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all rows and the n + 1 offsets into them; null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not (pa.types.is_string(column.type) or pa.types.is_large_string(column.type)):
        column = column.cast(pa.string())
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[bounds[0] : bounds[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, bounds - bounds[0]


def row_slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes; a longer text is a range of its own."""
    row, n = 0, len(offsets) - 1
    while row < n:
        stop = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        stop = min(max(stop, row + 1), n)
        yield row, stop
        row = stop


def split_words(data: np.ndarray, offsets: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end bytes of all maximal runs of ``keep`` bytes inside one text, and the word offsets of the texts."""
    inside = keep[data]
    first = inside.copy()
    last = inside.copy()
    if len(inside):
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        begin = offsets[:-1][np.diff(offsets) > 0]
        first[begin] = inside[begin]
        last[begin[1:] - 1] = inside[begin[1:] - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def scramble(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit numbers that spreads similar inputs."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprints(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit fingerprints of the byte ranges, equal for equal bytes and never 0."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, n + 1)[:n], out=sums[1:])
    codes = (sums[ends] - sums[starts]) * _powers(_INVERSE, n + 1)[starts]
    codes = scramble(codes + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    codes[codes == 0] = 1
    return codes


def word_codes(column: pa.Array, keep: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of all words of a text column and the n + 1 word offsets of its rows."""
    data, offsets = text_bytes(column)
    parts, counts = [], [np.zeros(1, np.int64)]
    for a, b in row_slices(offsets):
        raw = data[offsets[a] : offsets[b]]
        starts, ends, words = split_words(raw, offsets[a : b + 1] - offsets[a], keep)
        parts.append(fingerprints(LOWER[raw] if lower else raw, starts, ends))
        counts.append(np.diff(words))
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64), np.cumsum(np.concatenate(counts))


def window_codes(codes: np.ndarray, width: int) -> np.ndarray:
    """One fingerprint per run of ``width`` consecutive codes; len(codes) - width + 1 of them."""
    n = len(codes)
    if n < width:
        return np.zeros(0, np.uint64)
    out = np.zeros(n - width + 1, np.uint64)
    if width <= 8:
        for k in range(width):
            out = (out ^ codes[k : n - width + 1 + k]) * np.uint64(_BASE)
            out ^= out >> np.uint64(29)
        return scramble(out)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(codes * _powers(_BASE, n + 1)[:n], out=sums[1:])
    return scramble((sums[width:] - sums[:-width]) * _powers(_INVERSE, n + 1)[: n - width + 1])


def spans(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Owner and position inside the owner of each element of consecutive runs of the given lengths."""
    owner = np.repeat(np.arange(len(lengths)), lengths)
    begin = np.cumsum(lengths) - lengths
    return owner, np.arange(len(owner)) - np.repeat(begin, lengths)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenated index ranges [start, start + length)."""
    owner, inside = spans(lengths)
    return starts[owner] + inside
