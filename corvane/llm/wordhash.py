"""Words of whole texts as 64-bit hashes, vectorised over Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Bytes of text that are hashed at once, about; a longer text is taken whole.
BLOCK_BYTES = 1 << 20
SHINGLE = 5

_rng = np.random.default_rng(20240229)
_VALUES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ODD = _rng.integers(1, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose output bits depend on all input bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, BLOCK_BYTES + BLOCK_BYTES // 4)
        both = []
        for base in (_BASE, _INVERSE):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            both.append(np.multiply.accumulate(table))
        _powers[:] = both
    return _powers[0][:n], _powers[1][:n]


class Words(NamedTuple):
    data: np.ndarray  # bytes, A-Z lower-cased
    starts: np.ndarray  # of words, in data
    ends: np.ndarray
    hashes: np.ndarray
    rows: np.ndarray  # rows[i] .. rows[i + 1] are the words of the block's row i


def blocks(column: pa.Array, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int, Words]]:
    """(first row, row after the last, their words) for runs of about `size` bytes; null counts as empty."""
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        last = min(last, len(column))
        cuts = offsets[first : last + 1] - offsets[first]
        yield first, last, _words(_LOWER[data[offsets[first] : offsets[last]]], cuts)
        first = last


def _words(data: np.ndarray, cuts: np.ndarray) -> Words:
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = ~_SPACE[data]
    border = np.zeros(n + 1, bool)
    border[cuts] = True
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | border))
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | border))
    powers, inverse = _power_tables(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_VALUES[data] * powers[:n], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    return Words(data, starts, ends, hashes, np.searchsorted(starts, cuts))


def shingle_sets(words: Words, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """For each row the sorted distinct hashes of its runs of `size` words; fewer words: one hash of all; none: empty."""
    w, n = words.hashes, len(words.hashes)
    if n >= size:
        runs = w[: n - size + 1] * _ODD[0]
        for k in range(1, size):
            runs += w[k : n - size + 1 + k] * _ODD[k]
        runs = mix(runs)
    for a, b in zip(words.rows[:-1].tolist(), words.rows[1:].tolist(), strict=True):
        if b - a >= size:
            yield np.unique(runs[a : b - size + 1])
        else:
            yield mix((w[a:b] * _ODD[8 : 8 + b - a]).sum(keepdims=True) + np.uint64(b - a)) if b > a else w[:0]


def sequence_hashes(words: Words) -> Iterator[tuple[int, int]]:
    """For each row two independent hashes of its word sequence, as signed integers."""
    for a, b in zip(words.rows[:-1].tolist(), words.rows[1:].tolist(), strict=True):
        w = words.hashes[a:b]
        powers, _ = _power_tables(b - a + 1)
        # Products of odd powers: position matters in both sums.
        pair = np.array([(w * powers[: b - a]).sum(), (mix(w ^ _ODD[15]) * powers[: b - a]).sum()], np.uint64)
        yield tuple(mix(pair + np.uint64(b - a)).view(np.int64).tolist())
