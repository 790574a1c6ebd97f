"""Text columns as byte arrays: blocks of whole documents, words and their hashes, in numpy."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_ROOT = U64(0x9E3779B97F4A7C15)
_BACK = U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit integers."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def byte_view(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary array and its offsets; null counts as empty."""
    if isinstance(text, pa.ChunkedArray):
        text = text.combine_chunks()
    text = text.cast(pa.large_binary()) if not pa.types.is_large_binary(text.type) else text
    if text.null_count:
        text = text.fill_null(b"")
    if not len(text):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    buffers = text.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[text.offset:text.offset + len(text) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def trim() -> None:
    """Gives memory that earlier work of this Python worker no longer needs back to the machine."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not a C library that can
        pass


def tidy(operator: Callable) -> Callable:
    """An operator on a partition's batches that leaves no unused memory behind in its worker."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from operator(batches)
        trim()
    return run


def slices(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Cuts a batch into runs of rows of at most ``most`` bytes of text, one row at least."""
    trim()
    lengths = np.diff(byte_view(batch.column(column))[1])
    start, total = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if i > start and total + n > most:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if len(lengths) > start:
        yield batch.slice(start)


def blocks(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Regroups a partition's batches into blocks of about ``most`` bytes of text."""
    held, total = [], 0
    for batch in batches:
        for part in slices(batch, column, most):
            n = len(byte_view(part.column(column))[0])
            if held and total + n > most:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, total = [], 0
            held.append(part)
            total += n
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """A table that is True for the bytes within the given ranges."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low:high + 1] = True
    return table


SPACE = byte_class((0x20, 0x20), (0x09, 0x0D))
NOT_WORD = byte_class((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_CODES = mix(np.arange(1, 257, dtype=np.uint64) * _ROOT)
_POWERS = np.ones(1, np.uint64)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        steps = np.full(n, _ROOT)
        steps[0] = U64(1)
        _POWERS = np.multiply.accumulate(steps)
    return _POWERS[:n]


def words(data: np.ndarray, offsets: np.ndarray, outside: np.ndarray,
          lower: bool = True, breaks: np.ndarray | None = None
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document index of every maximal run of bytes not in ``outside``.

    A run also ends before each byte that ``breaks`` marks.
    """
    low = LOWER[data] if lower else data
    inside = ~outside[low]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True  # a document's first byte starts a word anew
    if breaks is not None:
        first[:-1] |= breaks
    before = np.concatenate(([False], inside[:-1])) if len(inside) else inside
    starts = np.flatnonzero(inside & (~before | first[:-1]))
    after = np.concatenate((inside[1:], [False])) if len(inside) else inside
    ends = np.flatnonzero(inside & (~after | first[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                lower: bool = True) -> np.ndarray:
    """64-bit hashes of byte runs, independent of where they stand."""
    low = LOWER[data] if lower else data
    powers = _powers(len(low) + 1)
    sums = np.zeros(len(low) + 1, np.uint64)
    np.cumsum(_CODES[low] * powers[:-1], out=sums[1:])
    value = sums[ends] - sums[starts]
    # shift every run to a common origin: multiply by the inverse power of its start
    return mix(value * _inverse(len(low) + 1)[starts] + (ends - starts).astype(np.uint64) * _CODES[7])


_INVERSE = np.ones(1, np.uint64)


def _inverse(n: int) -> np.ndarray:
    global _INVERSE
    if len(_INVERSE) < n:
        steps = np.full(n, _BACK)
        steps[0] = U64(1)
        _INVERSE = np.multiply.accumulate(steps)
    return _INVERSE[:n]


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The integers of many runs, one run after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)
