"""Exact nearest entries in a small table of integer vectors by a tree of split points.

Every node picks split points far from each other and hands each other entry to its nearest one. For
every pair of split point and child the node stores the least and the greatest distance of the
child's entries to the split point. A query measures its distance to the split points; by the
triangle inequality a child whose range keeps it farther than the best distance so far is left out
with its whole subtree.

Squared distances are integers and decide alone which entry is nearest, ties going to the lower
index. Only the elimination takes roots: distances are rounded down where they must be at least so
large and up where they must be at most so large, and a child goes only if it is strictly farther,
so no entry as near as the best is ever lost.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np

LEAF = 12
SPLITS = 12
#: Whole numbers up to here are exact in double precision.
EXACT = 1 << 53


class Node(NamedTuple):
    """Entries ``ids`` are compared here; ``children[j]`` holds those nearest to ``ids[j]``."""

    ids: np.ndarray
    children: list[Node | None]
    least: np.ndarray | None  # [i, j]: from split point i to the entries of child j
    most: np.ndarray | None


class Tree:
    """Nearest rows of ``entries`` (whole numbers, as doubles if ``exact`` or as Python integers)."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.exact = entries.dtype != object
        self.norms = _squares(entries)
        self.root = self._node(np.arange(len(entries)))

    def _node(self, ids: np.ndarray) -> Node:
        if len(ids) <= max(LEAF, SPLITS):
            return Node(ids, [], None, None)
        chosen = [0]
        nearest = _pairs(self.entries[ids[:1]], self.entries[ids])[0]
        while len(chosen) < SPLITS:
            free = nearest.copy()
            free[chosen] = -1
            chosen.append(int(np.argmax(free)))
            far = _pairs(self.entries[ids[chosen[-1:]]], self.entries[ids])[0]
            nearest = np.minimum(nearest, far)
        chosen.sort()
        splits = ids[chosen]
        others = np.delete(ids, chosen)
        to_splits = _pairs(self.entries[splits], self.entries[others])
        owner = to_splits.argmin(axis=0)
        least = np.zeros((SPLITS, SPLITS), to_splits.dtype)
        most = np.zeros((SPLITS, SPLITS), to_splits.dtype)
        children: list[Node | None] = []
        for j in range(SPLITS):
            mine = owner == j
            if not mine.any():
                children.append(None)
                continue
            least[:, j] = _down(to_splits[:, mine].min(axis=1))
            most[:, j] = _up(to_splits[:, mine].max(axis=1))
            children.append(self._node(others[mine]))
        return Node(splits, children, least, most)

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Index and squared distance of the nearest entry of each query, and distances taken."""
        search = _Search(self, queries)
        search.visit(self.root, np.arange(len(queries)))
        return search.index, search.best, search.taken


class _Search:
    def __init__(self, tree: Tree, queries: np.ndarray):
        self.tree, self.queries = tree, queries
        self.norms = _squares(queries)
        self.index = np.full(len(queries), len(tree.entries), np.int64)
        self.best = np.full(len(queries), np.inf, queries.dtype)
        self.taken = 0

    def visit(self, node: Node, rows: np.ndarray) -> None:
        if not len(rows):
            return
        squared = self._measured(node.ids, rows)
        place = squared.argmin(axis=1)  # ids ascend: the first is the lowest
        found, ids = squared[np.arange(len(rows)), place], node.ids[place]
        better = (found < self.best[rows]) | ((found == self.best[rows]) & (ids < self.index[rows]))
        self.best[rows[better]], self.index[rows[better]] = found[better], ids[better]
        if not node.children:
            return
        low, high = _down(squared), _up(squared)
        for own in (True, False):  # the child of the nearest split point first
            for j, child in enumerate(node.children):
                if child is None:
                    continue
                among = np.flatnonzero((place == j) == own)
                radius = _up(self.best[rows[among]])[:, None]
                out = (low[among] - node.most[:, j] > radius) | (
                    node.least[:, j] - high[among] > radius
                )
                self.visit(child, rows[among[~out.astype(bool).any(axis=1)]])

    def _measured(self, ids: np.ndarray, rows: np.ndarray) -> np.ndarray:
        self.taken += len(ids) * len(rows)
        tree = self.tree
        product = self.queries[rows] @ tree.entries[ids].T
        return self.norms[rows, None] - 2 * product + tree.norms[ids]


def _squares(vectors: np.ndarray) -> np.ndarray:
    if vectors.shape[1] == 0:
        return np.zeros(len(vectors), vectors.dtype)
    return (vectors * vectors).sum(axis=1)


def _pairs(some: np.ndarray, others: np.ndarray) -> np.ndarray:
    return _squares(some)[:, None] - 2 * (some @ others.T) + _squares(others)


def _roots(squared: np.ndarray) -> np.ndarray:
    """Roots of Python integers in units of 2 ** -20, rounded down; infinity stays."""
    return np.frompyfunc(lambda n: n if n == math.inf else math.isqrt(n << 40), 1, 1)(squared)


def _down(squared: np.ndarray) -> np.ndarray:
    """At most the root. Two roundings of a double lose less than a part in 2 ** 50."""
    if squared.dtype == object:
        return _roots(squared)
    return np.sqrt(squared) * (1 - 2.0**-50)


def _up(squared: np.ndarray) -> np.ndarray:
    """At least the root."""
    if squared.dtype == object:
        return _roots(squared) + 1
    return np.sqrt(squared) * (1 + 2.0**-50)


def fits_doubles(largest: float, length: int) -> bool:
    """Whether squared distances of such components, and all sums on the way, are exact doubles."""
    return 4 * max(length, 1) * largest * largest < EXACT
