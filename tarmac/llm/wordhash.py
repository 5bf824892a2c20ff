"""Words and word sequences of many texts at once, as arrays over their UTF-8 bytes.

A hash of 64 bits stands for a word or a sequence of words. Callers that must not err verify the
words themselves, or state that they rely on 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are worked on in slices of about so many bytes, which bounds a task's memory.
SLICE_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)
_powers: dict[int, np.ndarray] = {}


def _table(separators: list[int]) -> np.ndarray:
    """Byte to byte: A-Z to a-z, separators to 0."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    table[separators] = 0
    return table


#: Words of anything but ASCII blanks, and words of ASCII letters, digits and all beyond ASCII.
BLANK_SEPARATED = _table([0x20, *range(0x09, 0x0E)])
ALPHANUMERIC = _table(
    [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
)


def powers(base: int, n: int) -> np.ndarray:
    """base**0 ... base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        with np.errstate(over="ignore"):
            have = np.ones(max(n, SLICE_BYTES + 1), dtype=np.uint64)
            have[1:] = np.uint64(base)
            np.multiply.accumulate(have, out=have)
        _powers[base] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows with about ``limit`` bytes; null is empty."""
    if column.null_count:
        column = pc.fill_null(column, "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    buffers = column.buffers()
    raw = np.frombuffer(buffers[1], dtype=np.int64 if wide else np.int32)
    offsets = raw[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        end = min(max(end, row + 1), len(column))
        yield row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


class Words:
    """The words of one slice of texts.

    ``start`` and ``end`` are byte positions, ``first[d] : first[d + 1]`` are the words of text d.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, table: np.ndarray):
        self.data, self.offsets, self.mapped = data, offsets, table[data]
        inside = self.mapped != 0
        start, end = inside.copy(), inside.copy()
        if len(data):
            start[1:] &= ~inside[:-1]
            end[:-1] &= ~inside[1:]
            heads = offsets[:-1][offsets[:-1] < offsets[1:]]
            start[heads] = inside[heads]
            tails = offsets[1:][offsets[:-1] < offsets[1:]] - 1
            end[tails] = inside[tails]
        self.start = np.flatnonzero(start)
        self.end = np.flatnonzero(end) + 1
        self.first = np.searchsorted(self.start, offsets)
        self._sums: np.ndarray | None = None

    def hashes(self) -> np.ndarray:
        """A hash of each word's bytes, after lower-casing A-Z."""
        return self._hash(self.end)

    def prefix_hashes(self, n: int) -> np.ndarray:
        """A hash of each word's first n bytes, unlike that of any whole word."""
        return self._hash(np.minimum(self.end, self.start + n)) * _STEP + np.uint64(n)

    def _hash(self, end: np.ndarray) -> np.ndarray:
        n = len(self.mapped)
        if self._sums is None:
            self._sums = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum(self.mapped.astype(np.uint64) * powers(_BASE, n), out=self._sums[1:])
        h = (self._sums[end] - self._sums[self.start]) * powers(_INVERSE, n + 1)[self.start]
        return mix(h + (end - self.start).astype(np.uint64))

    def text(self, first: int, last: int) -> bytes:
        """The words first to last (not included), joined by one blank."""
        return b" ".join(self.mapped[a:b].tobytes() for a, b in zip(self.start[first:last], self.end[first:last]))


def sequence_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """The hash of each run of n words; run i starts at word i, whatever text it is in."""
    count = max(0, len(words) - n + 1)
    h = np.zeros(count, dtype=np.uint64)
    for k in range(n):
        h *= _STEP
        h += words[k : k + count]
    return mix(h + np.uint64(n))
