"""Byte-level text helpers, vectorised over small batches of whole documents.

Everything works on one buffer that holds the UTF-8 bytes of several documents, each
followed by one space. Hashes are polynomial prefix sums modulo 2**64 followed by a
mixing step, so the hash of any byte range costs the same whatever its length.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

#: Text bytes worked on at once; bounds the temporaries of a task.
BATCH_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_RANDOM = np.random.Generator(np.random.PCG64(20240229))
_BYTE_VALUES = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FOLDED_VALUES = _BYTE_VALUES.copy()
_FOLDED_VALUES[65:91] = _BYTE_VALUES[97:123]
_PLACES = _RANDOM.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits depend on all input bits."""
    x = values + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(length: int) -> list[np.ndarray]:
    if len(_powers[0]) < length:
        for slot, base in enumerate((_BASE, _BASE_INVERSE)):
            steps = np.full(length, base, np.uint64)
            steps[0] = 1
            _powers[slot] = np.cumprod(steps)
    return _powers


class RangeHash:
    """Hashes of byte ranges of one buffer; ``fold`` makes A-Z equal to a-z."""

    def __init__(self, buffer: np.ndarray, fold: bool = False):
        self._up, self._down = _power_tables(len(buffer) + 1)
        values = (_FOLDED_VALUES if fold else _BYTE_VALUES)[buffer]
        self._sums = np.zeros(len(buffer) + 1, np.uint64)
        np.cumsum(values * self._up[: len(buffer)], out=self._sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self._sums[ends] - self._sums[starts]) * self._down[starts])

    def windows(self, width: int) -> np.ndarray:
        """Hashes of all ranges of ``width`` bytes, by start."""
        count = len(self._sums) - width
        return mix((self._sums[width:] - self._sums[:count]) * self._down[:count])


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """One buffer with a space after each text, and where each text starts (plus the end)."""
    lengths = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(lengths + 1, out=starts[1:])
    return np.frombuffer(b" ".join(texts) + b" ", np.uint8), starts


def runs(member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], member, [False])).view(np.int8)))
    return edges[::2], edges[1::2]


def shingle_hashes(texts: list[bytes], words: int = 5) -> list[np.ndarray]:
    """Of each text the hashes of its word shingles, in text order, repeats included.

    A-Z count as a-z and words are separated by white space. A text with fewer
    words than a shingle has its whole word sequence as one; without words, none.
    """
    buffer, bounds = joined(texts)
    starts, ends = runs(~_BLANK[buffer])
    first = np.searchsorted(starts, bounds)
    hashes = RangeHash(buffer, fold=True)(starts, ends)
    long_enough = max(0, len(hashes) - words + 1)
    total = np.full(long_enough, np.uint64(words))
    for place in range(words):
        total += hashes[place : place + long_enough] * _PLACES[place]
    shingles = mix(total)
    found = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= words:
            found.append(shingles[a : b - words + 1])
        elif b > a:
            short = (hashes[a:b] * _PLACES[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            found.append(mix(np.array([short], np.uint64)))
        else:
            found.append(np.zeros(0, np.uint64))
    return found


def utf8(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """The texts of a column as bytes; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return [t or b"" for t in column.cast(pa.large_binary()).to_pylist()]


def portions(texts: list[bytes], limit: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Index ranges of at most ``limit`` bytes, or of one longer text."""
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text) + 1
    if start < len(texts):
        yield start, len(texts)


def shingled(batches: Iterable[pa.RecordBatch], words: int = 5):
    """For each row of Arrow batches with a ``text`` column: batch, row, shingle hashes."""
    for batch in batches:
        texts = utf8(batch.column("text"))
        for a, b in portions(texts):
            for i, hashes in enumerate(shingle_hashes(texts[a:b], words)):
                yield batch, a + i, hashes
