"""R-trees over count vectors, joined under an upper bound of the overlap of the sets.

The members of a set are hashed into ``GROUPS`` groups; the counts of the groups are the coordinates
of a point. Two sets share at most the sum of the smaller coordinates, and all sets below two nodes
at most the sum of the smaller upper corners. Counts are kept up to ``LIMIT``, which bounds nothing.
"""

from __future__ import annotations

import numpy as np

GROUPS = 512
LEAF = 16
FANOUT = 8
LIMIT = 65_535
UNLIMITED = 2**31 - 1


def count_vector(members: np.ndarray) -> np.ndarray:
    groups = (members & np.uint64(GROUPS - 1)).astype(np.int64)
    counts = np.bincount(groups, minlength=GROUPS)
    return np.minimum(counts, LIMIT).astype(np.uint16)


def unlimited(vectors: np.ndarray) -> np.ndarray:
    """The vectors with coordinates at the limit as large as any count."""
    full = vectors >= LIMIT
    return np.where(full, np.int32(UNLIMITED), vectors.astype(np.int32)) if full.any() else vectors


def needed(left: np.ndarray, right: np.ndarray, percent: int) -> np.ndarray:
    """Smallest overlap of sets of these sizes with a Jaccard similarity of ``percent`` hundredths."""
    total = percent * (np.asarray(left, np.int64) + np.asarray(right, np.int64))
    return -(-total // (100 + percent))


class RTree:
    """Nodes level by level, leaves first: rows of a node, its upper corner and its sizes."""

    def __init__(self, vectors: np.ndarray, sizes: np.ndarray):
        self.vectors, self.sizes = unlimited(vectors).astype(np.int32), sizes.astype(np.int64)
        widest = vectors.var(axis=0).argmax() if len(vectors) else 0
        self.order = np.lexsort((vectors[:, widest], self.sizes))
        corner = self.vectors[self.order]
        low = high = self.sizes[self.order]
        self.levels = []
        step = LEAF
        while True:
            begin = np.arange(0, len(corner), step)
            corner = np.maximum.reduceat(corner, begin, axis=0)
            low, high = np.minimum.reduceat(low, begin), np.maximum.reduceat(high, begin)
            self.levels.append((corner, low, high))
            if len(begin) == 1:
                break
            step = FANOUT

    def children(self, level: int, node: int) -> range:
        below = len(self.levels[level - 1][0]) if level else len(self.order)
        step = FANOUT if level else LEAF
        return range(node * step, min((node + 1) * step, below))


def _possible(corner, low, high, corners, lows, highs, percent: int) -> np.ndarray:
    """Which of several nodes may hold a partner of a set below one node."""
    shared = np.minimum(corners, corner).sum(axis=1)
    return (
        (shared >= needed(low, lows, percent))
        & (100 * high >= percent * lows)
        & (100 * highs >= percent * low)
    )


def join(left: RTree, right: RTree, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs whose bound reaches the needed overlap, descending both trees together."""
    out_left, out_right = [], []
    stack = [(len(left.levels) - 1, 0, len(right.levels) - 1, np.array([0]))]
    while stack:
        level, node, other_level, others = stack.pop()
        corner, low, high = (x[node] for x in left.levels[level])
        corners, lows, highs = (x[others] for x in right.levels[other_level])
        others = others[_possible(corner, low, high, corners, lows, highs, percent)]
        if not len(others):
            continue
        if other_level:
            others = np.concatenate([list(right.children(other_level, o)) for o in others])
            other_level -= 1
            if level == 0:
                stack.append((level, node, other_level, others))
                continue
        if level:
            for child in left.children(level, node):
                stack.append((level - 1, child, other_level, others))
            continue
        if other_level:
            stack.append((level, node, other_level, others))
            continue
        rows = right.order[np.concatenate([list(right.children(0, o)) for o in others])]
        for place in left.children(0, node):
            row = left.order[place]
            size = left.sizes[row]
            near = _possible(
                left.vectors[row], size, size,
                right.vectors[rows], right.sizes[rows], right.sizes[rows], percent,
            )
            out_left.append(np.full(int(near.sum()), row))
            out_right.append(rows[near])
    if not out_left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(out_left), np.concatenate(out_right)
