"""Random-projection trees and the search of a whole forest through one priority queue, in numpy.

A tree is three arrays: ``plane`` (a row for each inner node), ``offset`` and ``child`` (two
for each inner node; a leaf is ``-1 - number``), and ``size``, the sample's points in each leaf.
"""

from __future__ import annotations

import heapq

import numpy as np

Tree = dict[str, np.ndarray]


def grow(points: np.ndarray, leaf: int, seed: int) -> Tree:
    """Splits between two random centres, drawn towards the points nearer to each, until ``leaf`` points are left."""
    draw = np.random.default_rng(seed)
    planes, offsets, children, sizes = [], [], [], []
    todo = [(np.arange(len(points)), -1, 0)]
    while todo:
        rows, parent, side = todo.pop()
        split = _split(points, rows, draw) if len(rows) > max(leaf, 1) else None
        if split is None:
            number = -1 - len(sizes)
            sizes.append(len(rows))
        else:
            number, (plane, offset, right) = len(planes), split
            planes.append(plane)
            offsets.append(offset)
            children.append([0, 0])
            todo += [(rows[right], number, 1), (rows[~right], number, 0)]
        if parent >= 0:
            children[parent][side] = number
    dims = points.shape[1]
    return {
        "plane": np.array(planes, np.float32).reshape(-1, dims), "offset": np.array(offsets, np.float32),
        "child": np.array(children, np.int32).reshape(-1, 2), "size": np.array(sizes, np.int64),
    }


def _split(points: np.ndarray, rows: np.ndarray, draw: np.random.Generator):
    some = points[draw.choice(rows, min(len(rows), 256), replace=False)].astype(np.float64)
    for _ in range(4):
        a, b = some[draw.choice(len(some), 2, replace=False)] if len(some) > 1 else (some[0], some[0])
        for _ in range(3):
            near = ((some - a) ** 2).sum(axis=1) < ((some - b) ** 2).sum(axis=1)
            if near.all() or not near.any():
                break
            a, b = some[near].mean(axis=0), some[~near].mean(axis=0)
        length = np.linalg.norm(b - a)
        if not length:
            continue
        plane = ((b - a) / length).astype(np.float32)
        side = points[rows] @ plane
        offset = np.float32((a + b) @ plane / 2)
        right = side > offset
        if 0 < right.sum() < len(rows):
            return plane, offset, right
    return None


def leaves(tree: Tree, points: np.ndarray) -> np.ndarray:
    """The leaf of each point."""
    at = np.full(len(points), 0 if len(tree["plane"]) else -1)
    inner = np.flatnonzero(at >= 0)
    while len(inner):
        node = at[inner]
        right = np.einsum("ij,ij->i", points[inner], tree["plane"][node]) > tree["offset"][node]
        at[inner] = tree["child"][node, right.astype(np.int64)]
        inner = inner[at[inner] >= 0]
    return -1 - at


def probe(trees: list[Tree], point: np.ndarray, wanted: float) -> list[tuple[int, int]]:
    """(tree, leaf) in the order of one queue over all trees, until the leaves hold ``wanted`` sample points in sum."""
    margins = [tree["plane"] @ point - tree["offset"] for tree in trees]
    queue = [(0.0, t, 0 if len(tree["plane"]) else -1) for t, tree in enumerate(trees)]
    found, held = [], 0
    while queue and held < wanted:
        far, t, node = heapq.heappop(queue)
        # Down the near side at once: it is no farther. Squared distances to the planes add up.
        while node >= 0:
            margin, (left, right) = float(margins[t][node]), trees[t]["child"][node].tolist()
            near, other = (right, left) if margin > 0 else (left, right)
            heapq.heappush(queue, (far + margin * margin, t, other))
            node = near
        found.append((t, -1 - node))
        held += int(trees[t]["size"][-1 - node])
    return found
