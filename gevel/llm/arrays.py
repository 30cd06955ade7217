"""Texts of an Arrow batch as one byte array: words, lines and span hashes without a Python loop per word."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers = {_BASE: np.ones(1, np.uint64), _INVERSE: np.ones(1, np.uint64)}


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows, and where each row begins and ends; null is empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, starts, data = column.buffers()
    offsets = np.frombuffer(starts, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batch: pa.RecordBatch, size: int = PIECE) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``size`` bytes of its column ``text``; a longer text is alone."""
    _, offsets = text_bytes(batch.column("text"))
    row = 0
    while row < batch.num_rows:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, side="right")) - 1)
        yield batch.slice(row, end - row)
        row = end


def per_piece(work: Callable[[pa.RecordBatch], pa.RecordBatch | None]) -> Callable:
    """``work`` over each piece, as a function for ``mapInArrow``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                if (out := work(piece)) is not None:
                    yield out

    return run


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each run of true bytes, cut at row ends; and the first run of each row."""
    n = len(inside)
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    edges = offsets[(offsets > 0) & (offsets < n)]
    before[edges] = False
    after[edges - 1] = False
    starts = np.flatnonzero(inside & ~before)
    return starts, np.flatnonzero(inside & ~after) + 1, np.searchsorted(starts, offsets)


def owner(first: np.ndarray) -> np.ndarray:
    """The row of each item, from the bounds of the rows."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def _power(base: np.uint64, n: int) -> np.ndarray:
    if len(_powers[base]) < n:
        table = np.full(max(n, PIECE + 1), base, np.uint64)
        table[0] = 1
        _powers[base] = np.multiply.accumulate(table)
    return _powers[base][:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


class SpanHash:
    """64-bit hashes of any spans of a byte array, by differences of one running sum."""

    def __init__(self, data: np.ndarray) -> None:
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power(_BASE, len(data)), out=self.sums[1:])
        self.inverse = _power(_INVERSE, len(data) + 1)

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.inverse[starts])


def totals(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of the values of each row; rows without values get 0."""
    run = np.zeros((len(values) + 1, *values.shape[1:]), np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, axis=0, out=run[1:])
    return run[first[1:]] - run[first[:-1]]


def greatest(values: np.ndarray, first: np.ndarray, empty: float = 0.0) -> np.ndarray:
    """Largest value of each row."""
    out = np.full(len(first) - 1, empty, values.dtype)
    some = first[1:] > first[:-1]
    if some.any():
        out[some] = np.maximum.reduceat(values, first[:-1][some])
    return out
