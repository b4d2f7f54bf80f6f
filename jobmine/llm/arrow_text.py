"""Vectorised work on Arrow text columns: word bounds and 64-bit word hashes.

Texts are taken in slices of about a megabyte, so a task needs memory for a few slices (or for its
longest text, a few dozen bytes per word of it), whatever the number of rows in an Arrow batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (finaliser of splitmix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _whitespace() -> np.ndarray:
    table = np.zeros(256, bool)
    table[0x20] = True
    table[0x09:0x0E] = True
    return table


_STEP = 0x9E3779B97F4A7C15 | 1
_STEP_BACK = pow(_STEP, -1, 1 << 64)
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _U(0xD1B54A32D192ED03))
_SPACE = _whitespace()
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: dict[int, np.ndarray] = {}


def _power(base: int, size: int) -> np.ndarray:
    known = _powers.get(base)
    if known is None or len(known) < size:
        known = np.full(max(size, SLICE_BYTES + 1), _U(base))
        known[0] = 1
        known = np.cumprod(known)
        if size <= 4 * SLICE_BYTES:
            _powers[base] = known
    return known[:size]


def strings(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column without nulls, and the bounds of its texts in them."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, bounds, data = column.buffers()
    if bounds is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    bounds = np.frombuffer(bounds, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data, bounds.astype(np.int64)


def slices(column, size: int = SLICE_BYTES, rows: int = 20_000) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, bounds from 0) of runs of at most ``rows`` rows with
    about ``size`` bytes."""
    data, bounds = strings(column)
    first, end = 0, len(bounds) - 1
    while first < end:
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + size, "right")) - 1)
        last = min(last, first + rows, end)
        yield first, last, data[bounds[first]:bounds[last]], bounds[first:last + 1] - bounds[first]
        first = last


def word_bounds(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+`` of each text."""
    word = ~_SPACE[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[bounds] = True
    starts = word.copy()
    starts[1:] &= ~word[:-1] | cut[1:-1]
    ends = word
    ends[:-1] &= ~word[1:] | cut[1:-1]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``data[start:end]``: differences of a running polynomial, then mixed."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):  # blocks of whole spans bound the memory for long texts
        last = max(at + 1, int(np.searchsorted(ends, starts[at] + SLICE_BYTES, "right")))
        lo, hi = int(starts[at]), int(ends[last - 1])
        total = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(_BYTE[data[lo:hi]] * _power(_STEP, hi - lo), out=total[1:])
        s, e = starts[at:last] - lo, ends[at:last] - lo
        raw = (total[e] - total[s]) * _power(_STEP_BACK, hi - lo + 1)[s]
        out[at:last] = mix(raw ^ (e - s).astype(np.uint64) * _U(0xA0761D6478BD642F))
        at = last
    return out


def words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words with A-Z lower-cased, number of words before each text and in all)."""
    starts, ends = word_bounds(data, bounds)
    return span_hashes(_LOWER[data], starts, ends), np.searchsorted(starts, bounds)


def list_column(values: np.ndarray, bounds: np.ndarray, kind=pa.int64()) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind))
