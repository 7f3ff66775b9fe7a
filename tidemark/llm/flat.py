"""Texts of a batch as flat byte arrays: their words, and hashes of any run of them, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_CODES = np.random.default_rng(20240229).integers(0, 1 << 64, 256, dtype=np.uint64)  # fixed: all workers agree
_STEP = 0x9E3779B97F4A7C15
_BACK = pow(_STEP, -1, 1 << 64)


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows; null rows are empty."""
    column = column.fill_null("").cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def parts(batch: pa.RecordBatch, place: int, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of about ``most`` bytes of text in column ``place``, a row at least."""
    offsets = bytes_of(batch.column(place))[1]
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def range_hash(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial hashes of values[start:end], the same wherever the range stands."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * _powers(_STEP, len(values))[:-1], dtype=np.uint64)])
    back = _powers(_BACK, int(start.max(initial=0)))
    return _mix((sums[end] - sums[start]) * back[start])


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First byte, end, row and hash of every word, a run of bytes other than ASCII white space."""
    blank = _BLANK[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    word = ~blank
    begin = np.flatnonzero(word & np.r_[True, blank[:-1]] | word & first[:-1])
    end = np.flatnonzero(word & np.r_[blank[1:], True] | word & first[1:]) + 1
    row = np.searchsorted(offsets, begin, side="right") - 1
    return begin, end, row, range_hash(_CODES[data], begin, end)
