"""Words and their hashes, many texts at a time, straight from Arrow's buffers.

A word is ``[^\\x20\\x09-\\x0D]+``. Hashes are 64 bits wide, depend on the bytes of the word alone and are the same in every
process. Texts are taken in chunks of about a megabyte, so the memory held does not grow with the table; one text is never cut.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


class Words(NamedTuple):
    """The words of rows ``first`` up to ``last`` of a column; ``row`` counts from ``first``."""

    first: int
    last: int
    data: np.ndarray  # the bytes of these rows
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    sizes: np.ndarray  # bytes of each row

    @property
    def count(self) -> np.ndarray:
        return np.bincount(self.row, minlength=self.last - self.first)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; a null is an empty text."""
    if column.null_count:
        column = column.fill_null("")
    width = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    if offsets is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(offsets, width, len(column) + 1, column.offset * np.dtype(width).itemsize).astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data, offsets


def word_chunks(column: pa.Array, chunk: int = CHUNK_BYTES):
    """The words of a string column as a series of :class:`Words`; every row is in exactly one, empty ones too."""
    data, offsets = text_buffers(column)
    first, n = 0, len(column)
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + chunk, "right")) - 1)
        part = data[offsets[first] : offsets[last]]
        cuts = offsets[first : last + 1] - offsets[first]
        blank = np.ones(len(part) + 1, bool)
        blank[:-1] = SPACE[part]
        word = ~blank[:-1]
        begin = word.copy()
        begin[1:] &= blank[:-2]
        inner = cuts[1:-1]
        inner = inner[inner < len(part)]
        begin[inner] = word[inner]  # a text's first byte begins a word even when the text before has no space at its end
        stop = word & blank[1:]
        before = inner[inner > 0] - 1
        stop[before] = word[before]
        start, end = np.flatnonzero(begin), np.flatnonzero(stop) + 1
        row = np.searchsorted(cuts, start, "right") - 1
        yield Words(first, last, part, start, end, row, np.diff(cuts))
        first = last


_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
        for k, base in enumerate((BASE, inverse)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.multiply.accumulate(steps)
    return _POWERS[0], _POWERS[1]


def word_hashes(w: Words, data: np.ndarray | None = None) -> np.ndarray:
    """A hash of each word's bytes; ``data`` replaces the bytes, for example by lower-case ones."""
    data = w.data if data is None else data
    if not len(w.start):
        return np.zeros(0, np.uint64)
    power, inverse = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=total[1:])
    return mix((total[w.end] - total[w.start]) * inverse[w.start] + (w.end - w.start).astype(np.uint64))


def runs_hash(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash of every run of ``length`` consecutive word hashes, by its first place; runs may cross texts, the caller drops those."""
    if len(hashes) < length:
        return np.zeros(0, np.uint64)
    power, inverse = _powers(len(hashes) + 1)
    total = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * power[: len(hashes)], out=total[1:])
    return mix((total[length:] - total[:-length]) * inverse[: len(hashes) - length + 1] + np.uint64(length))


def shingles(w: Words, hashes: np.ndarray, length: int) -> list[np.ndarray]:
    """For each row the sorted distinct hashes of its runs of ``length`` words.

    A text of fewer words has one shingle, all its words; a text without words has none.
    """
    counts = w.count
    ends = np.cumsum(counts)
    runs = runs_hash(hashes, length)
    found = []
    for n, end in zip(counts, ends, strict=True):
        if n >= length:
            found.append(np.unique(runs[end - n : end - length + 1]))
        elif n:
            found.append(runs_hash(hashes[end - n : end], int(n)))
        else:
            found.append(np.zeros(0, np.uint64))
    return found
