"""A packed R-tree over whole-number vectors, and its best-first search by inner product.

Points are packed by sort-tile-recursive: sorted by one coordinate and cut into slabs, these by
the next coordinate, and so on; runs of the last order are leaves, runs of nodes their parents.
Every node has the minimum bounding box of its points. For a query a, coordinate i of a box adds
between min and max of a_i * low_i and a_i * high_i to the inner product; the sums bound the
scores of all points of the box.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np

LEAF = 256
FANOUT = 8
# Coordinates by which points are tiled.
AXES = 3


@dataclass
class Window:
    """Scores that count, the least that can still matter, and the best points so far as (score, id), best first."""

    low: int
    high: int
    top: int
    floor: int
    same_label: bool
    found: list[tuple[int, int]]

    @property
    def least(self) -> int:
        return max(self.low, self.floor)

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        """Takes points in; the ``top`` best stay, ties by smaller id, and the last of them raises the floor."""
        inside = np.flatnonzero((scores >= self.least) & (scores <= self.high))
        if len(inside) > self.top:
            # The last score wanted stays with all its ties.
            inside = inside[scores[inside] >= np.partition(scores[inside], len(inside) - self.top)[len(inside) - self.top]]
        if len(inside):
            both = self.found + list(zip(scores[inside].tolist(), ids[inside].tolist()))
            self.found = sorted(both, key=lambda p: (-p[0], p[1]))[: self.top]
            if len(self.found) == self.top:
                self.floor = max(self.floor, int(self.found[-1][0]))


def axes_of(points: np.ndarray) -> list[int]:
    """The coordinates that spread most, first the widest."""
    return np.argsort(-points.var(axis=0), kind="stable")[:AXES].tolist()


def tiled(points: np.ndarray, axes: list[int], leaf: int) -> np.ndarray:
    """The order of sort-tile-recursive packing."""

    def cut(rows: np.ndarray, axes: list[int]) -> list[np.ndarray]:
        rows = rows[np.argsort(points[rows, axes[0]], kind="stable")]
        leaves = -(-len(rows) // leaf)
        if len(axes) == 1 or leaves < 2:
            return [rows]
        slabs = int(np.ceil(leaves ** (1 / len(axes))))
        step = -(-leaves // slabs) * leaf
        return [part for at in range(0, len(rows), step) for part in cut(rows[at : at + step], axes[1:])]

    return np.concatenate(cut(np.arange(len(points)), axes))


class Tree:
    """``points`` with their ids and labels, packed. ``exact`` is a type in which all scores are exact."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, labels: np.ndarray, exact: type, leaf: int = LEAF, fanout: int = FANOUT):
        order = tiled(points, axes_of(points), leaf)
        self.points, self.ids, self.labels = points[order].astype(exact), ids[order], labels[order]
        starts = np.arange(0, len(order), leaf)
        low, high = (f.reduceat(self.points, starts, axis=0) for f in (np.minimum, np.maximum))
        # Nodes by level, leaves first: the span of points of a leaf, the span of children of others.
        self.spans = [(s, min(s + leaf, len(order))) for s in starts.tolist()]
        self.leaves, at, size = len(starts), 0, len(starts)
        lows, highs = [low], [high]
        while size > 1:
            starts = np.arange(0, size, fanout)
            self.spans += [(at + s, at + min(s + fanout, size)) for s in starts.tolist()]
            low, high = np.minimum.reduceat(low, starts, axis=0), np.maximum.reduceat(high, starts, axis=0)
            lows.append(low)
            highs.append(high)
            at, size = at + size, len(starts)
        self.low, self.high = np.concatenate(lows), np.concatenate(highs)

    def search(self, query: np.ndarray, label: int, own: int, upper: np.ndarray, lower: np.ndarray, windows: list[Window]) -> int:
        """Fills the windows by a queue of nodes, highest possible score first; returns the number of points compared.

        A node is left out if its scores lie outside of every window or strictly below what
        a window's last place holds; equal ones count, as their ids may be smaller.
        """
        highest = max(w.high for w in windows)
        root, compared = len(self.spans) - 1, 0
        queue = [(-min(int(upper[root]), highest), root)]
        while queue:
            bound, node = heapq.heappop(queue)
            if -bound < min(w.least for w in windows):
                break
            if not any(upper[node] >= w.least and lower[node] <= w.high for w in windows):
                continue
            first, last = self.spans[node]
            if node >= self.leaves:
                for child in range(first, last):
                    if any(upper[child] >= w.least and lower[child] <= w.high for w in windows):
                        heapq.heappush(queue, (-min(int(upper[child]), highest), child))
                continue
            compared += last - first
            scores = (self.points[first:last] @ query).astype(np.int64)
            same = self.labels[first:last] == label
            own_row = self.ids[first:last] == own
            for window in windows:
                rows = np.flatnonzero((same if window.same_label else ~same) & ~own_row)
                window.offer(scores[rows], self.ids[first:last][rows])
        return compared


def bounds(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The largest and the smallest inner product of each query with any point of each box."""
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    return up @ high.T + down @ low.T, up @ low.T + down @ high.T
