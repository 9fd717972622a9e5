"""Words, lines and shingles of many texts at once, in numpy over Arrow's own buffers.

All hashes are 64 bits wide. Two different words, lines or shingles of one comparison share a hash with a
chance of about 2**-64 a pair; results count such a pair as equal.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at a time; a longer text is a block of its own.
BLOCK_BYTES = 1 << 18
#: ASCII white space as the word pattern [^\x20\x09-\x0D]+ has it.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15 | 1)
_INVERSE = _U(pow(int(_BASE), -1, 1 << 64))
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: list[np.ndarray] = [np.ones(1, _U), np.ones(1, _U)]


def _return_memory() -> None:
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library keeps what it keeps
        pass


def lean(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``work`` for mapInArrow; at the end of a task the worker, which goes on to others, returns the memory that it has free."""

    @functools.wraps(work)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            _return_memory()

    return run


def _power_tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        n = max(n, BLOCK_BYTES + 1)
        for i, base in enumerate((_BASE, _INVERSE)):
            table = np.full(n, base, _U)
            table[0] = 1
            _powers[i] = np.multiply.accumulate(table)
    return _powers


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ _U((seed * 0xD6E8FEB86659FD93 + seed) & (2**64 - 1))
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(32))) * _U(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> _U(29))


def text_blocks(texts: pa.Array | pa.ChunkedArray, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of whole texts; a null text has no bytes."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    n = len(texts)
    if not n:
        return
    _, offsets_buffer, data_buffer = texts.buffers()
    offsets = np.frombuffer(offsets_buffer, np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer is not None and data_buffer.size else np.empty(0, np.uint8)
    row = 0
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + block_bytes, "right")) - 1
        end = min(max(end, row + 1), n)
        yield row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


class Words:
    """Words of one block: starts, ends, and ``first``, the index of each text's first word (and one more)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, is_gap: np.ndarray = _IS_SPACE):
        self.data, self.offsets = data, offsets
        inside = ~is_gap[data]
        begin, finish = inside.copy(), inside.copy()
        if len(data):
            begin[1:] &= ~inside[:-1]
            finish[:-1] &= ~inside[1:]
            cuts = offsets[1:-1]
            cuts = cuts[(cuts > 0) & (cuts < len(data))]  # a text's first byte begins a word, the byte before ends one
            begin[cuts] = inside[cuts]
            finish[cuts - 1] = inside[cuts - 1]
        self.inside = inside
        self.starts = np.flatnonzero(begin)
        self.ends = np.flatnonzero(finish) + 1
        self.first = np.searchsorted(self.starts, offsets)

    def __len__(self) -> int:
        return len(self.starts)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts())

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.starts, self.ends)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of data[start:end] for each span, by differences of one running polynomial."""
    powers, inverses = _power_tables(len(data) + 1)
    total = np.empty(len(data) + 1, _U)
    total[0] = 0
    np.multiply(data.astype(_U) + _U(1), powers[: len(data)], out=total[1:])
    np.cumsum(total, out=total)
    return mix((total[ends] - total[starts]) * inverses[starts])


def shingle_hashes(words: np.ndarray, first: np.ndarray, k: int, short: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first of each text) of all runs of k words; with ``short``, a text of fewer, but not none, is one run."""
    factors = mix(np.arange(1, k + 1, dtype=_U), 77) | _U(1)
    counts = np.diff(first)
    n = len(words)
    windows = np.maximum(counts - (k - 1), 0)
    kept = windows.copy()
    if short:
        kept[(counts > 0) & (counts < k)] = 1
    out_first = np.concatenate(([0], np.cumsum(kept)))
    out = np.empty(out_first[-1], _U)
    if n >= k:
        full = words[: n - k + 1] * factors[0]
        for j in range(1, k):
            full += words[j : n - k + 1 + j] * factors[j]
        full = mix(full)
        at = np.arange(windows.sum()) + np.repeat(first[:-1] - np.concatenate(([0], np.cumsum(windows)[:-1])), windows)
        to = np.arange(windows.sum()) + np.repeat(out_first[:-1] - np.concatenate(([0], np.cumsum(windows)[:-1])), windows)
        out[to] = full[at]
    if short:
        for length in range(1, k):
            at = np.flatnonzero(counts == length)
            total = np.zeros(len(at), _U)
            for j in range(length):
                total += words[first[at] + j] * factors[j]
            out[out_first[at]] = mix(total, length)
    return out, out_first
