"""A packed R-tree over count vectors with an overlap bound.

A set's items are hashed into groups; its point is the number of items per
group.  The overlap of two sets is at most the sum of their points' coordinate
minima, and below a box at most the sum of minima with the box's upper corner.
"""

from __future__ import annotations

import numpy as np

FANOUT = 16


def needed(na, nb, percent: int):
    """Least overlap with 100 * overlap >= percent * union."""
    return -(-(percent * (na + nb)) // (100 + percent))


class PackedRTree:
    """Points sorted by size and then by leading coordinates, boxes of ``FANOUT`` children."""

    def __init__(self, points: np.ndarray):
        self.size = points.sum(axis=1)
        self.order = np.lexsort((points[:, 1], points[:, 0], self.size))
        upper, low, high = points[self.order], self.size[self.order], self.size[self.order]
        self.levels = [(upper, low, high)]
        while len(upper) > FANOUT:
            at = np.arange(0, len(upper), FANOUT)
            upper = np.maximum.reduceat(upper, at, axis=0)
            low, high = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
            self.levels.append((upper, low, high))

    def search(self, point: np.ndarray, percent: int) -> np.ndarray:
        """Positions of points whose overlap bound with ``point`` reaches ``percent`` similarity."""
        n = point.sum()
        at = np.arange(len(self.levels[-1][0]))
        for depth in range(len(self.levels) - 1, -1, -1):
            upper, low, high = self.levels[depth]
            bound = np.minimum(upper[at], point).sum(axis=1)
            # sizes in the box: the overlap needed grows with the size, the similar sizes are a range
            size = np.maximum(low[at], -(-percent * n // 100))
            fits = (size <= high[at]) & (100 * n >= percent * low[at]) & (bound >= needed(n, size, percent))
            at = at[fits]
            if depth:
                at = (at[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                at = at[at < len(self.levels[depth - 1][0])]
        return self.order[at]
