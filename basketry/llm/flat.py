"""Vectorised text: many documents as one byte array, words as index ranges.

An Arrow string column already is one UTF-8 byte array with offsets.  Words
are found with boolean masks over that array, and every word is hashed at
once from prefix sums: with ``H[i] = sum(value(byte j) * P**j, j < i)`` modulo
2**64, the hash of bytes ``s..e`` is ``(H[e] - H[s]) * P**-s``.  A final mix
spreads the bits.  Batches are cut into slices of about ``SLICE`` bytes, so
memory does not follow the batch size; only a single longer document makes a
longer slice.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE = 1 << 20
_P = 0x9E3779B97F4A7C15 | 1
_PINV = pow(_P, -1, 1 << 64)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

#: \x20 and \x09-\x0D, the separators of words.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: A-Z to a-z, other bytes unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads all 64 bits (wraps modulo 2**64)."""
    x = x.astype(np.uint64)
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x2545F4914F6CDD1D))
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    got = _powers.get(base)
    if got is None or len(got) < n:
        full = np.full(max(n, SLICE + 1), base, np.uint64)
        full[0] = 1
        got = np.cumprod(full, dtype=np.uint64)
        if len(got) <= 2 * SLICE:
            _powers[base] = got
    return got


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                values: np.ndarray | None = None) -> np.ndarray:
    """64-bit hashes of the ranges ``starts..ends`` of the bytes ``data`` (or of ``values``)."""
    n = len(data)
    h = np.zeros(n + 1, np.uint64)
    np.cumsum((_VALUES[data] if values is None else values) * _power(_P, n)[:n], out=h[1:])
    return mix((h[ends] - h[starts]) * _power(_PINV, n + 1)[starts]
               + (ends - starts).astype(np.uint64))


class Running:
    """Hashes of many ranges of ``values``, those of each size comparable with each other (not mixed)."""

    def __init__(self, values: np.ndarray):
        self.n = n = len(values)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * _power(_P, n)[:n], out=self.sums[1:])
        self.back = _power(_PINV, n + 1)

    def all(self, size: int) -> np.ndarray:
        """Of the ranges of ``size`` values from every place on."""
        return (self.sums[size:] - self.sums[:self.n + 1 - size]) * self.back[:self.n + 1 - size]

    def at(self, starts: np.ndarray, size: int) -> np.ndarray:
        return (self.sums[starts + size] - self.sums[starts]) * self.back[starts]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null text is empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)), at


def slices(at: np.ndarray) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``SLICE`` bytes each."""
    i, n = 0, len(at) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + SLICE, "right")) - 1)
        yield i, min(j, n)
        i = j


@dataclass
class Words:
    """Words of a slice: byte ranges in ``data``, and ``first[d]..first[d+1]`` per document."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.starts, self.ends)

    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def spans(data: np.ndarray, at: np.ndarray, inside: np.ndarray) -> Words:
    """Maximal runs of ``inside`` bytes that do not cross the documents' offsets ``at``."""
    n = len(data)
    edge = np.zeros(n + 1, bool)
    edge[at] = True
    left = np.empty(n, bool)
    right = np.empty(n, bool)
    if n:
        left[0], left[1:] = True, ~inside[:-1]
        right[-1], right[:-1] = True, ~inside[1:]
    starts = np.flatnonzero(inside & (left | edge[:-1]))
    ends = np.flatnonzero(inside & (right | edge[1:])) + 1
    return Words(data, starts, ends, np.searchsorted(starts, at))


def words(data: np.ndarray, at: np.ndarray, i: int, j: int, lower: bool = True) -> Words:
    """Words (runs without ``SPACE``) of documents ``i..j`` of a batch, A-Z lowered."""
    own = data[at[i]:at[j]]
    own = LOWER[own] if lower else own
    return spans(own, at[i:j + 1] - at[i], ~SPACE[own])
