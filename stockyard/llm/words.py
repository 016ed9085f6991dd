"""Words and word shingles of a batch of texts as 64-bit hashes, without a Python object per word.

A word is a run of bytes other than space and ``\\t\\n\\v\\f\\r``, with A-Z in lower case. Its hash is a sum of one
random multiple per byte and place (multilinear hashing), finished by a mixer.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from stockyard.llm.common import text_bytes

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values in which each input bit changes half of the output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def stream(seed: int, n: int) -> np.ndarray:
    """The first ``n`` of a fixed row of pseudo-random 64-bit values."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


_BYTE = stream(11, 256)
_NEXT = stream(12, 256) | np.uint64(1)


class Words:
    """Words of a batch: ``start`` and ``end`` in the bytes, ``doc`` the text, ``first`` each text's first word (and the end)."""

    def __init__(self, column: pa.Array):
        raw, self.offsets = text_bytes(column)
        self.raw = raw
        data = _LOWER[raw]
        inside = ~_SPACE[data]
        begins = np.zeros(len(data) + 1, bool)
        begins[self.offsets] = True
        after = np.empty(len(data), bool)  # a break before this byte
        if len(data):
            after[0] = True
            after[1:] = ~inside[:-1]
        after |= begins[:-1]
        self.start = np.flatnonzero(inside & after)
        breaks = np.append(after[1:] | ~inside[1:], True) if len(data) else np.zeros(0, bool)
        self.end = np.flatnonzero(inside & breaks) + 1
        self.first = np.searchsorted(self.start, self.offsets)
        self.doc = np.repeat(np.arange(len(column)), np.diff(self.first))
        self.hash = self._hashes(data)

    def _hashes(self, data: np.ndarray) -> np.ndarray:
        if not len(self.start):
            return np.zeros(0, np.uint64)
        lengths = self.end - self.start
        most = int(lengths.max())
        place = _NEXT if most <= len(_NEXT) else stream(12, most) | np.uint64(1)
        at = np.repeat(self.start - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
        within = at - np.repeat(self.start, lengths)
        value = _BYTE[data[at]] * place[within]
        sums = np.add.reduceat(value, np.cumsum(lengths) - lengths)
        return mix(sums + lengths.astype(np.uint64))


_TURN = stream(13, 64) | np.uint64(1)


def runs(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` values."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j in range(size):
        total += hashes[j : j + n] * _TURN[j]
    return mix(total + np.uint64(size))


def shingle_sets(column: pa.Array, size: int = 5) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its ``size``-word shingles.

    A text with fewer words has one shingle, its whole sequence; without words the set is empty.
    """
    words = Words(column)
    out = []
    for a, b in zip(words.first[:-1], words.first[1:]):
        own = words.hash[a:b]
        out.append(np.unique(runs(own, min(size, len(own)))) if len(own) else np.zeros(0, np.uint64))
    return out


class Permutations:
    """``count`` multiply-add hashes of 64-bit values and the least value of each over a set."""

    def __init__(self, count: int, seed: int = 21):
        self.times = stream(seed, count) | np.uint64(1)
        self.plus = stream(seed + 1, count)

    def least(self, sets: list[np.ndarray]) -> np.ndarray:
        """(sets, count) minima; every set must have a value."""
        values = np.concatenate(sets)
        at = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
        out = np.empty((len(sets), len(self.times)), np.uint64)
        for k, (a, b) in enumerate(zip(self.times, self.plus)):
            out[:, k] = np.minimum.reduceat(values * a + b, at)
        return out
