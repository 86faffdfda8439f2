"""A cover tree over vectors on the unit sphere, and a traversal of two trees for close pairs.

Levels are nested: the centres of a level stay centres on the next, whose radius is half as large. Every node
knows the range of points below it and how far they really reach (its covering radius).
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

_LEAF = 16
# Distances from products of unit vectors are that far off at most.
_SLACK = 1e-6


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


class CoverTree:
    """``points`` are unit vectors. Node n covers ``order[begin[n]:end[n]]`` within ``reach[n]``."""

    def __init__(self, points: np.ndarray):
        self.points = points
        self.order = np.arange(len(points))
        self.centre, self.begin, self.end, self.reach = [0], [0], [len(points)], [0.0]
        self.children: list[np.ndarray] = [np.empty(0, np.int64)]
        if not len(points):
            return
        self.reach[0] = float(distances(points[:1], points).max())
        level, radius = [0], 2.0
        while level:
            radius /= 2
            level = [child for node in level for child in self._split(node, radius)]
        self.centre, self.reach = np.array(self.centre), np.array(self.reach)

    def _split(self, node: int, radius: float) -> list[int]:
        """Cover a node's points by balls of ``radius``, the first around the node's own centre."""
        begin, end = self.begin[node], self.end[node]
        if end - begin <= _LEAF or self.reach[node] <= _SLACK:
            return []
        if self.reach[node] <= radius:
            return [node]  # one ball: the node is its own and only child on this level
        left, centre = self.order[begin:end].copy(), self.centre[node]
        kids, at = [], begin
        while len(left):
            away = distances(self.points[centre : centre + 1], self.points[left])[0]
            inside = (away <= radius) | (left == centre)
            own = left[inside]
            self.order[at : at + len(own)] = own
            self.centre.append(centre)
            self.begin.append(at)
            self.end.append(at + len(own))
            self.reach.append(float(away[inside].max()))
            self.children.append(np.empty(0, np.int64))
            kids.append(len(self.begin) - 1)
            at += len(own)
            left = left[~inside]
            centre = int(left[0]) if len(left) else -1
        self.children[node] = np.array(kids)
        return kids

    def below(self, node: int) -> np.ndarray:
        return self.order[self.begin[node] : self.end[node]]


def close_pairs(a: CoverTree, b: CoverTree, radius: float, found: Callable[[np.ndarray, np.ndarray], None]) -> None:
    """Call ``found`` with sets of points of both trees that hold every pair within ``radius``.

    Each pair of points is in at most one call. A pair of nodes is dropped if the distance of the
    centres less both covering radii is above ``radius``. For a tree with itself every unordered pair of
    nodes is visited once.
    """
    if not len(a.points) or not len(b.points):
        return
    same = a is b
    stack = [(0, 0)]
    while stack:
        x, y = stack.pop()
        left, right = a.children[x], b.children[y]
        if not len(left) and not len(right):
            found(a.below(x), b.below(y))
            continue
        left = left if len(left) else np.array([x])
        right = right if len(right) else np.array([y])
        away = distances(a.points[a.centre[left]], b.points[b.centre[right]])
        near = away - a.reach[left][:, None] - b.reach[right][None, :] <= radius + _SLACK
        if same and x == y:
            near &= np.tri(len(left), dtype=bool).T
        i, j = np.nonzero(near)
        stack.extend(zip(left[i].tolist(), right[j].tolist(), strict=True))
