"""Words and n-gram hashes of Arrow text columns, computed on whole byte buffers.

A batch of texts is one byte buffer with offsets.  Words are runs of bytes
outside a separator set, so every step is an array operation, whatever the
number of texts.  All hashes depend on content alone: they agree between
tasks, retries and machines.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

# texts of a batch are worked on in pieces of about this many bytes; one longer text is one piece
PIECE_BYTES = 1 << 20

_BYTE_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_WORD_FACTOR = np.uint64(0xC2B2AE3D27D4EB4F)
_S30, _S27, _S31 = np.uint64(30), np.uint64(27), np.uint64(31)
_MIX_A, _MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = (h ^ (h >> _S30)) * _MIX_A
    h = (h ^ (h >> _S27)) * _MIX_B
    return h ^ (h >> _S31)


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """Membership table of the given inclusive byte ranges."""
    table = np.zeros(256, dtype=bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


WHITE_SPACE = byte_set((0x20, 0x20), (0x09, 0x0D))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * _BYTE_FACTOR)


def _inverse(factor: np.uint64) -> np.uint64:
    """Inverse of an odd number modulo 2**64."""
    return np.uint64(pow(int(factor), -1, 1 << 64))


class _Powers:
    """Powers of a factor and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, factor: np.uint64):
        self._factors = factor, _inverse(factor)
        self._tables = [np.ones(1, dtype=np.uint64)] * 2

    def upto(self, n: int) -> list[np.ndarray]:
        if len(self._tables[0]) < n:
            size = max(n, PIECE_BYTES + (PIECE_BYTES >> 2))
            self._tables = [
                np.concatenate(([np.uint64(1)], np.cumprod(np.full(size - 1, f, dtype=np.uint64))))
                for f in self._factors
            ]
        return [t[:n] for t in self._tables]


_byte_powers = _Powers(_BYTE_FACTOR)
_word_powers = _Powers(_WORD_FACTOR)


class Piece(NamedTuple):
    """Texts ``first`` to ``last`` (exclusive) of a batch as one buffer."""

    first: int
    last: int
    data: np.ndarray
    bounds: np.ndarray


def pieces(
    column: pa.Array | pa.ChunkedArray, size: int = PIECE_BYTES, rows: int | None = None
) -> Iterator[Piece]:
    """Cut a text column into buffers of about ``size`` bytes, and of at most ``rows`` texts; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_binary())
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        last = min(last, len(column), first + rows if rows else len(column))
        bounds = offsets[first : last + 1] - offsets[first]
        yield Piece(first, last, data[offsets[first] : offsets[last]], bounds)
        first = last


class Words(NamedTuple):
    """Byte span and text number (within the piece) of every word, in order."""

    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    # of each text, the number of its first word; one entry more than texts
    first: np.ndarray


def words(data: np.ndarray, bounds: np.ndarray, separators: np.ndarray) -> Words:
    """Maximal runs of bytes that are no separators; a run never crosses a text border."""
    inside = ~separators[data]
    before = np.empty(len(data), dtype=bool)
    after = np.empty(len(data), dtype=bool)
    if len(data):
        before[0] = after[-1] = True
        np.logical_not(inside[:-1], out=before[1:])
        np.logical_not(inside[1:], out=after[:-1])
        filled = bounds[1:] > bounds[:-1]
        before[bounds[:-1][filled]] = True
        after[bounds[1:][filled] - 1] = True
    start = np.flatnonzero(inside & before)
    end = np.flatnonzero(inside & after) + 1
    first = np.searchsorted(start, bounds)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(first))
    return Words(start, end, text, first)


class SpanHashes:
    """64-bit content hashes of byte spans of one buffer."""

    def __init__(self, data: np.ndarray):
        power, self._inverse = _byte_powers.upto(len(data) + 1)
        self._sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_BYTE_VALUES[data] * power[: len(data)], out=self._sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self._sums[end] - self._sums[start]) * self._inverse[start] + (end - start).astype(np.uint64))


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit content hash of each byte span."""
    return SpanHashes(data).of(start, end)


def window_hashes(hashes: np.ndarray, text: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``n`` consecutive words of one text, and the number of the first word of each."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    power, inverse = _word_powers.upto(len(hashes))
    sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes * power, out=sums[1:])
    at = np.flatnonzero(text[:count] == text[n - 1 :])
    return mix((sums[at + n] - sums[at]) * inverse[at] + np.uint64(n)), at


class Span(NamedTuple):
    """Part of a text in code points, and the number of its kind."""

    start: int
    kind: int
    end: int


def apart(base: list[Span], added: list[Span]) -> list[Span]:
    """``added`` (in order) without those that overlap a span of ``base`` (by start)."""
    # the furthest end so far makes one comparison per span enough
    starts, ends, reach = [s.start for s in base], [], 0
    for s in base:
        reach = max(reach, s.end)
        ends.append(reach)
    out = []
    for s in added:
        before = bisect_left(starts, s.end)
        if not before or ends[before - 1] <= s.start:
            out.append(s)
    return out
