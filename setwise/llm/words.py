"""Words of UTF-8 texts as arrays: positions and 64-bit hashes, for use inside tasks.

A word is a maximal run of bytes other than space and 0x09-0x0D. The arrays come straight
from Arrow's buffers, so no Python object is made per word, and a batch is hashed in slices
of bounded length, however long a text is.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

WORD_PATTERN = r"[^\x20\x09-\x0D]+"
SLICE_BYTES = (1 << 18) - 1
BATCH_BYTES = 2 << 20

_MIX_1, _MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_ODD = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * _MIX_1
    x = (x ^ (x >> np.uint64(27))) * _MIX_2
    return x ^ (x >> np.uint64(31))


def constants(n: int, seed: int) -> np.ndarray:
    """``n`` fixed odd 64-bit numbers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_ODD) + np.uint64(seed)) | np.uint64(1)


_BYTE_VALUES = constants(256, 11)


@lru_cache(maxsize=6)
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64, and of its inverse."""

    def run(b: int) -> np.ndarray:
        out = np.full(n, b, dtype=np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    return run(base), run(pow(base, -1, 1 << 64))


def _pow2(n: int, least: int = 1 << 12) -> int:
    return max(least, 1 << (n - 1).bit_length())


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A hash of ``values[s:e]`` for each run: equal runs get equal hashes wherever they are."""
    base = int(constants(1, 101 + seed)[0])
    powers, inverse = _powers(base, _pow2(len(values) + 1))
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * powers[: len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * np.uint64(_ODD))


def separators() -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[[9, 10, 11, 12, 13, 32]] = True
    return table


_SEPARATOR = separators()
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Words:
    """The words of the texts of one batch.

    ``hashes[i]``, ``starts[i]``, ``ends[i]``: hash and byte range of word i;
    ``first[d]:first[d + 1]``: the words of text d.
    """

    def __init__(self, texts: pa.Array, lower: bool = False):
        self.data, self.offsets = text_bytes(texts)
        self.starts, self.ends = word_ranges(self.data, self.offsets)
        self.first = np.searchsorted(self.starts, self.offsets)
        self.hashes = hash_ranges(self.data, self.starts, self.ends, lower)

    def __len__(self) -> int:
        return len(self.first) - 1

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def windows(self, size: int, seed: int) -> np.ndarray:
        """Hash of the ``size`` words from each word on, regardless of where texts end."""
        n = max(0, len(self.hashes) - size + 1)
        out = np.zeros(n, dtype=np.uint64)
        for i, factor in enumerate(constants(size, seed)):
            out += self.hashes[i : i + n] * factor
        return mix(out)

    def window_counts(self, size: int) -> np.ndarray:
        """Windows of ``size`` words that lie in each text."""
        return np.maximum(0, self.counts() - size + 1)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row and where each begins; null counts as empty."""
    texts = texts.cast(pa.large_string()) if not pa.types.is_large_string(texts.type) else texts
    if texts.null_count:
        texts = texts.fill_null("")
    if len(texts) == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    _, where, data = texts.buffers()
    offsets = np.frombuffer(where, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None:
        return np.zeros(0, dtype=np.uint8), offsets - offsets[0]
    return np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_ranges(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = _SEPARATOR) -> tuple[np.ndarray, np.ndarray]:
    inside = ~separator[data]
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    begins[edges] = inside[edges]  # a text ends the word of the text before
    stops[edges - 1] = inside[edges - 1]
    return np.flatnonzero(begins), np.flatnonzero(stops) + 1


def hash_ranges(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """Hashes of byte ranges in order, in slices of bounded length."""
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        at = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, at + SLICE_BYTES, side="right")))
        part = data[at : ends[j - 1]]
        values = _BYTE_VALUES[_LOWER[part] if lower else part]
        out[i:j] = run_hashes(values, starts[i:j] - at, ends[i:j] - at)
        i = j
    return out


def small_batches(batches: Iterator[pa.RecordBatch], text: str, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of each hold about ``most`` bytes, one text at least."""
    for batch in batches:
        sizes = np.diff(text_bytes(batch.column(text))[1])
        ends = np.cumsum(sizes)
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(at, to - at)
            at = to


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def sums_by_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of ``values[first[d]:first[d + 1]]`` for each text d."""
    total = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]
