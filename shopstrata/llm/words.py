"""Words of whole Arrow batches as NumPy arrays: positions, hashes, hashes of word windows.

Texts are never turned into Python objects; a batch is one array of bytes. Hashes are
polynomials modulo 2**64 over random byte values, finished by a mixing step; two seeds give
independent families, so a pair of them is a 128-bit digest.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACES = np.zeros(256, bool)
SPACES[[32, *range(9, 14)]] = True
#: All of ASCII but letters and digits.
NO_LETTERS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SLICE_BYTES = 1 << 20
BATCH_BYTES = 4 << 20


class Words(NamedTuple):
    data: np.ndarray  # bytes of all texts
    starts: np.ndarray  # of each word in data
    ends: np.ndarray
    docs: np.ndarray  # words of text i are docs[i]:docs[i + 1]

    def lengths(self) -> np.ndarray:
        return np.diff(self.docs)

    def owner(self) -> np.ndarray:
        """Number of the text that each word is in."""
        return np.repeat(np.arange(len(self.docs) - 1), self.lengths())


def text_slices(texts: pa.Array, limit: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes of text each, one row at least."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    low, done = 0, 0
    while low < len(sizes):
        high = max(low + 1, int(np.searchsorted(sizes, done + limit, "right")))
        yield low, high
        low, done = high, sizes[high - 1]


def words_of(texts: pa.Array, lower: bool = False, separators: np.ndarray = SPACES) -> Words:
    """All words of the texts; null has none."""
    array = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(array.buffers()[1], np.int64, len(array) + 1, array.offset * 8)
    raw = array.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0]:offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    inside = ~separators[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(first)
    return Words(LOWER[data] if lower else data, starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets))


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@lru_cache(8)
def _family(seed: int) -> tuple[np.ndarray, int, int]:
    numbers = np.random.Generator(np.random.PCG64(seed)).integers(0, 1 << 64, 258, dtype=np.uint64)
    return numbers[:256], int(numbers[256]) | 1, int(numbers[257]) | 1


@lru_cache(8)
def _powers(base: int, length: int) -> np.ndarray:
    steps = np.full(length, base, np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


def hash_words(words: Words, seed: int = 1) -> np.ndarray:
    """A 64-bit hash of every word's bytes."""
    values, base, _ = _family(seed)
    inverse = pow(base, -1, 1 << 64)
    out = np.empty(len(words.starts), np.uint64)
    low = 0
    while low < len(out):
        high = max(low + 1, int(np.searchsorted(words.ends, words.starts[low] + SLICE_BYTES, "right")))
        begin, end = words.starts[low], words.ends[high - 1]
        size = SLICE_BYTES if end - begin < SLICE_BYTES else 1 << int(end - begin).bit_length()
        sums = np.zeros(end - begin + 1, np.uint64)
        np.cumsum(values[words.data[begin:end]] * _powers(base, size)[:end - begin], out=sums[1:])
        s, e = words.starts[low:high] - begin, words.ends[low:high] - begin
        out[low:high] = (sums[e] - sums[s]) * _powers(inverse, size)[s] + (e - s).astype(np.uint64)
        low = high
    return mix(out)


def hash_windows(hashes: np.ndarray, width: int, seed: int = 1) -> np.ndarray:
    """A hash of each run of ``width`` hashes, by doubling; the last width - 1 places have none."""
    base = _family(seed)[2]
    total, done, part, size = None, 0, hashes, 1
    bits = width
    while bits:
        if bits & 1:
            if total is None:
                total, done = part, size
            else:
                n = len(hashes) - done - size + 1
                if n <= 0:
                    return np.zeros(0, np.uint64)
                total = total[:n] * np.uint64(pow(base, size, 1 << 64)) + part[done:done + n]
                done += size
        bits >>= 1
        if bits:
            n = len(hashes) - 2 * size + 1
            if n <= 0:
                return np.zeros(0, np.uint64)
            part = part[:n] * np.uint64(pow(base, size, 1 << 64)) + part[size:size + n]
            size *= 2
    return mix(total.copy())


def signed(hashes: np.ndarray) -> pa.Array:
    return pa.array(hashes.view(np.int64))


def runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All numbers of the ranges start, start + 1, ... of the given lengths, in order."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) - np.repeat(ends - lengths, lengths) + np.repeat(starts, lengths)
