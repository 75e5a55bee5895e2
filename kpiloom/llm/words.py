"""Words, shingles and their hashes for whole Arrow columns, without a Python object per word.

A word is a run of bytes other than 0x20 and 0x09-0x0D; A-Z count as a-z. All
words of a block of texts are hashed at once: every byte is looked up in a
table of random 64-bit numbers, multiplied by a power of an odd base, and
summed up; the difference of two running sums, divided by the power at its
start, depends on the word's bytes alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from kpiloom.llm.common import utf8_parts

_BASE = 0x9E3779B97F4A7C15
_RANDOM = np.random.Generator(np.random.PCG64(20240229))
_BYTES = _RANDOM.integers(1, 2**64, 256, np.uint64, endpoint=False)
_BYTES[65:91] = _BYTES[97:123]  # A-Z as a-z
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_PLACES = _RANDOM.integers(1, 2**64, 64, np.uint64, endpoint=False) | np.uint64(1)
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers, at least, of the base and of its inverse modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, 1 << 20)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            _powers[k:k + 1] = [np.cumprod(factors, dtype=np.uint64)]
    return _powers[0], _powers[1]


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that every bit of the input reaches every bit of the result."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def running(data: np.ndarray) -> np.ndarray:
    """Running sums by which ``span_hashes`` hashes any stretch of ``data``."""
    power, _ = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * power[:len(data)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, inverse = powers(len(sums))
    return mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * np.uint64(_BASE))


def word_spans(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of the texts, and where each text's words begin. between: the bytes that are in no word."""
    space = between[data]
    inner = ~space
    first, last = inner.copy(), inner.copy()
    first[1:] &= space[:-1]
    last[:-1] &= space[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    first[cuts] = inner[cuts]
    last[cuts - 1] = inner[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words of the texts, and where each text's words begin."""
    starts, ends, begin = word_spans(data, offsets)
    return span_hashes(running(data), starts, ends), begin


def shingle_sets(column: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray, list[np.ndarray]]]:
    """For blocks of texts: the first row, a hash of every text's word sequence, and its sorted distinct shingles.

    A text of fewer than ``width`` words is one shingle, one without words none.
    """
    for row, _, data, offsets in utf8_parts(column):
        words, begin = word_hashes(data, offsets)
        count = len(words) - width + 1
        rolled = np.zeros(max(count, 0), np.uint64)
        for k in range(width if count > 0 else 0):
            rolled += words[k:k + count] * _PLACES[k]
        rolled = mixed(rolled)
        power, inverse = powers(len(words) + 1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * power[:len(words)], dtype=np.uint64)])
        a, b = begin[:-1], begin[1:]
        whole = mixed((sums[b] - sums[a]) * inverse[a] + (b - a).astype(np.uint64) * _PLACES[0])
        sets = []
        for i, (s, e) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
            if e - s >= width:
                got = np.sort(rolled[s:e - width + 1])
                sets.append(got[np.concatenate([[True], got[1:] != got[:-1]])])
            else:
                sets.append(whole[i:i + 1] if e > s else whole[:0])
        yield row, whole, sets
