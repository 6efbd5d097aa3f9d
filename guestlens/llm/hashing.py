"""Hashes of words and word windows, computed for whole batches of texts in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from guestlens.llm.common import utf8

_BLOCK = 1 << 19  # bytes hashed at once
_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_GRAM = np.uint64(0xD6E8FEB86659FD93)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64, kept per process up to a block."""
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        have = np.full(n, base, np.uint64)
        have[:1] = 1
        have = np.multiply.accumulate(have)
        if n <= _BLOCK + 1:
            _powers[int(base)] = have
    return have[:n]


@dataclass
class Words:
    """The words of some texts: bytes, where each word begins and ends, where each text's words begin."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # of each text, and the number of all words at the end

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        """The text that each word stands in."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def left(self) -> np.ndarray:
        """Words from each word to the end of its text, itself included."""
        return np.repeat(self.first[1:], self.counts) - np.arange(len(self.starts))


def words(column: pa.Array) -> Words:
    """Cut texts at space and 0x09 to 0x0D; null and empty texts have no words."""
    data, offsets = utf8(column)
    inside = np.empty(len(data) + 2, bool)
    inside[0] = inside[-1] = False
    np.logical_not(_SPACE[data], out=inside[1:-1])
    begins = inside[1:-1] & ~inside[:-2]
    stops = inside[1:-1] & ~inside[2:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    begins[edges] = inside[1:-1][edges]
    stops[edges - 1] = inside[1:-1][edges - 1]
    starts = np.flatnonzero(begins)
    return Words(data, starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, offsets))


def distinct(w: Words) -> tuple[list[bytes], np.ndarray]:
    """The different words, and which of them each word is."""
    data, ends = w.data[~_SPACE[w.data]], np.concatenate([[0], np.cumsum(w.ends - w.starts)])
    buffers = [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)]
    coded = pa.Array.from_buffers(pa.large_binary(), len(w.starts), buffers).dictionary_encode()
    return coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()


def word_hashes(w: Words, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each word; ``lower`` takes A-Z as a-z."""
    table = _BYTE[_LOWER] if lower else _BYTE
    out = np.empty(len(w.starts), np.uint64)
    a = 0
    while a < len(out):
        b = max(a + 1, int(np.searchsorted(w.starts, w.starts[a] + _BLOCK)))
        while b > a + 1 and w.ends[b - 1] - w.starts[a] > _BLOCK:
            b -= 1
        low, high = int(w.starts[a]), int(w.ends[b - 1])
        total = np.zeros(high - low + 1, np.uint64)
        np.cumsum(table[w.data[low:high]] * _power(_BASE, high - low), out=total[1:])
        s, e = w.starts[a:b] - low, w.ends[a:b] - low
        out[a:b] = (total[e] - total[s]) * _power(_INVERSE, high - low + 1)[s] + (e - s).astype(np.uint64)
        a = b
    return mix(out)


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of ``k`` hashes, texts not regarded; shorter by k - 1."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = hashes[:n].copy()
    for j in range(1, k):
        out *= _GRAM
        out += hashes[j : j + n]
    return mix(out)


def whole(hashes: np.ndarray, w: Words) -> np.ndarray:
    """One hash per text over all of its words in order."""
    at = np.arange(len(hashes), dtype=np.uint64) - np.repeat(w.first[:-1], w.counts).astype(np.uint64)
    terms = mix(hashes + at * _GRAM)
    total = np.concatenate([[np.uint64(0)], np.cumsum(terms, dtype=np.uint64)])
    return mix(total[w.first[1:]] - total[w.first[:-1]] + w.counts.astype(np.uint64))
