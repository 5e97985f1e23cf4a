"""Inverted multi-index: one codebook for each half of the vectors.

The two codebooks form a product grid of cells; a vector is filed under its
nearest centre of each half.  Cells are visited in the order of a sum of two
half costs, which a heap over the two sorted halves gives without looking at
the whole grid (multi-sequence traversal).
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import cut

#: Vectors that codebooks are fitted on, at most about; every vector is filed.
SAMPLE = 8_192
#: A key with more than this share of the rows is hot; there are at most HOT of them.
HOT = 1_000


@dataclass
class Codebooks:
    """Centres of the left and the right half, ``k`` each."""

    left: np.ndarray
    right: np.ndarray

    @property
    def k(self) -> int:
        return len(self.left)

    @property
    def half(self) -> int:
        return self.left.shape[1]

    def distances(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances of each row's halves to the centres."""
        return squared(x[:, :self.half], self.left), squared(x[:, self.half:], self.right)

    def cells(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.distances(x)
        return a.argmin(axis=1), b.argmin(axis=1)


def squared(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    d = (x * x).sum(axis=1)[:, None] - 2.0 * (x @ centres.T) + (centres * centres).sum(axis=1)
    return np.maximum(d, 0.0)


def k_means(x: np.ndarray, k: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    """``k`` centres (fewer distinct rows give fewer); an empty centre stays where it was."""
    rng = np.random.default_rng(seed)
    distinct = np.unique(x, axis=0)
    centres = distinct[rng.permutation(len(distinct))[:k]].copy()
    for _ in range(rounds):
        own = squared(x, centres).argmin(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        size = np.bincount(own, minlength=len(centres))
        centres[size > 0] = sums[size > 0] / size[size > 0, None]
    return centres


def fit(sample: np.ndarray, k: int) -> Codebooks:
    """Independent codebooks of the two halves, with equally many centres."""
    half = (sample.shape[1] + 1) // 2
    left, right = k_means(sample[:, :half], k), k_means(sample[:, half:], k)
    k = min(len(left), len(right))
    return Codebooks(left[:k], right[:k])


def multi_sequence(left: np.ndarray, right: np.ndarray) -> Iterator[tuple[int, int, float]]:
    """Every cell (i, j) with ``left[i] + right[j]``, the least sums first."""
    a, b = np.argsort(left, kind="stable"), np.argsort(right, kind="stable")
    heap = [(left[a[0]] + right[b[0]], 0, 0)]
    while heap:
        cost, x, y = heapq.heappop(heap)
        yield int(a[x]), int(b[y]), float(cost)
        # each cell has one parent: (x, y - 1), or (x - 1, 0) in the first column
        if y + 1 < len(b):
            heapq.heappush(heap, (left[a[x]] + right[b[y + 1]], x, y + 1))
        if y == 0 and x + 1 < len(a):
            heapq.heappush(heap, (left[a[x + 1]] + right[b[0]], x + 1, 0))


def first_cells(left: np.ndarray, right: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``top`` cells (i, j) of each row's multi-sequence, for a batch at once.

    The cell of ranks (x, y) comes after (x + 1) * (y + 1) - 1 others, so only
    ranks with (x + 1) * (y + 1) <= top can be among the first.
    """
    k = left.shape[1]
    top = min(top, k * k)
    a, b = np.argsort(left, axis=1, kind="stable"), np.argsort(right, axis=1, kind="stable")
    x, y = np.divmod(np.arange(k * k), k)
    near = (x + 1) * (y + 1) <= top
    x, y = x[near], y[near]
    cost = np.take_along_axis(left, a, 1)[:, x] + np.take_along_axis(right, b, 1)[:, y]
    order = np.argsort(cost, axis=1, kind="stable")[:, :top]
    return np.take_along_axis(a, x[order], 1), np.take_along_axis(b, y[order], 1)


def matrix(column: pa.Array) -> np.ndarray:
    """A list column of equally long lists without nulls as rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def identified(vectors: DataFrame, name: str, *cols: Column) -> DataFrame:
    """``cols`` and a unique ``uid`` of every row, written once so that the ids hold."""
    return cut(vectors.select(*cols, F.monotonically_increasing_id().alias("uid")), name)


def finite(vec: str, limit: float = float("inf")) -> Column:
    """True where an array of doubles is not empty and all entries are below ``limit`` in size."""
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit))
    return F.col(vec).isNotNull() & (F.size(vec) > 0) & fine


def same_length(rows: DataFrame, vec: str) -> DataFrame:
    """The rows of the most common vector length (of several, the least)."""
    sizes = rows.groupBy(F.size(vec).alias("dim")).count()
    best = sizes.orderBy(F.desc("count"), "dim").limit(1).collect()
    return rows.where(F.size(vec) == best[0]["dim"]) if best else rows


def sampled(rows: DataFrame, n: int, vec: str, size: int = SAMPLE) -> np.ndarray:
    """About ``size`` vectors, drawn by the hash of their unique id; never more than twice that."""
    draw = F.pmod(F.xxhash64("uid"), F.lit(1 << 30)) / float(1 << 30)
    got = rows.where(draw < min(1.0, size / max(n, 1))).select(vec).limit(2 * size).toPandas()[vec]
    if not len(got):  # a tiny table can miss the draw
        got = rows.select(vec).limit(1).toPandas()[vec]
    return np.stack([np.asarray(v, float) for v in got]) if len(got) else np.zeros((0, 0))


def renewed(df: DataFrame) -> DataFrame:
    """The same columns under new identities, for a cogroup of two frames with a common origin."""
    return df.toDF(*df.columns)


def spread_join(many: DataFrame, one: DataFrame, key: str, count: str, total: int) -> DataFrame:
    """``many`` joined with ``one`` on ``key``, a unique key of ``one`` with its rows in ``many`` as ``count``.

    Keys with more than 1/HOT of all rows (at most HOT keys, whatever the
    size) are broadcast, so no task holds the rows of a hot key; the others
    meet in a shuffle where no key is large.
    """
    hot = one.where(F.col(count) * HOT > total)
    rest = one.where(F.col(count) * HOT <= total)
    cold = many.join(F.broadcast(hot.select(key)), key, "left_anti")
    return many.join(F.broadcast(hot), key).unionByName(cold.join(rest, key))
