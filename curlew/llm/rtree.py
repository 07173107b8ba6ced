"""Packed R-trees over count vectors, searched for points whose overlap with a query may reach a required size.

A point holds how many elements of a set fall into each hash group. Two sets share at most sum(min(a, b)) elements over the
groups, and a node's box (coordinate maxima, least and greatest set size) bounds that sum for every point below it.

The number of groups is a power of two that follows the set's size, so that a group holds one element at most on average: with fewer
groups the bound of large sets tells nothing. A vector folds to half as many groups by adding its halves. Sets that can be
linked differ in size by less than a factor of two, so their vectors differ by one fold at most for similarities over a half.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

FANOUT = 16
LEAST = 64
FULL = 255


def resolution(sizes: np.ndarray) -> np.ndarray:
    """Groups for sets of these sizes: the power of two from the size up, LEAST or more."""
    return np.maximum(LEAST, 2 ** np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64))


def counts(hashes: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """The count vector of each set hashes[bounds[i]:bounds[i + 1]]; a count of FULL stands for that many or more."""
    groups = resolution(np.diff(bounds))
    out = []
    high = hashes >> np.uint64(17)
    for i, g in enumerate(groups.tolist()):
        found = np.bincount((high[bounds[i] : bounds[i + 1]] & np.uint64(g - 1)).astype(np.int64), minlength=g)
        out.append(np.minimum(found, FULL).astype(np.uint8).tobytes())
    return out


def fold(points: np.ndarray, groups: int) -> np.ndarray:
    """points (n x more groups) with their groups added up to fewer; FULL stays FULL or more."""
    while points.shape[1] > groups:
        half = points.shape[1] // 2
        points = points[:, :half] + points[:, half:]
    return points


def may_link(a: bytes, b: bytes, size_a: int, size_b: int, num: int, den: int) -> bool:
    """The bound for one pair of sets."""
    if min(size_a, size_b) * den < max(size_a, size_b) * num:
        return False
    x, y = (np.frombuffer(v, np.uint8).astype(np.int32)[None] for v in (a, b))
    if (x >= FULL).any() or (y >= FULL).any():
        return True
    groups = min(x.shape[1], y.shape[1])
    shared = int(np.minimum(fold(x, groups), fold(y, groups)).sum())
    return shared * (num + den) >= num * (size_a + size_b)


class CountTree:
    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        """points: count vectors; sizes: the sets' sizes. Leaves hold neighbours in (size, fullest group) order."""
        self.order = np.lexsort((points.argmax(1), sizes))
        self.levels = [(points[self.order], sizes[self.order], sizes[self.order])]
        while len(self.levels[-1][0]) > FANOUT:
            box, low, high = self.levels[-1]
            cuts = np.arange(0, len(box), FANOUT)
            self.levels.append((np.maximum.reduceat(box, cuts), np.minimum.reduceat(low, cuts), np.maximum.reduceat(high, cuts)))

    def search(self, point: np.ndarray, size: int, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the points that may have den * overlap >= num * union with the query, and their bounds on the overlap's
        share of both sizes. None that has is missed."""
        found = np.arange(len(self.levels[-1][0]))
        for depth in range(len(self.levels) - 1, -1, -1):
            box, low, high = self.levels[depth]
            found = found[(high[found] * den >= num * size) & (low[found] * num <= den * size)]
            shared = np.minimum(box[found], point)
            shared = np.where((shared >= FULL).any(1), np.iinfo(np.int32).max, shared.sum(1, dtype=np.int64))
            # overlap / (size + other - overlap) >= num / den
            fits = shared * (num + den) >= num * (size + low[found])
            found, shared = found[fits], shared[fits]
            if depth:
                below = (found[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                found = below[below < len(self.levels[depth - 1][0])]
        return self.order[found], shared / (size + low[found])


def join(vectors: list[bytes], sizes: np.ndarray, labels: np.ndarray, num: int, den: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(i, positions j, bounds) over all pairs that may be linked and whose labels differ, each pair once."""
    groups = np.array([len(v) for v in vectors])
    classes = {g: np.flatnonzero(groups == g) for g in np.unique(groups).tolist()}
    points = {g: np.frombuffer(b"".join([vectors[i] for i in at]), np.uint8).astype(np.int16).reshape(-1, g) for g, at in classes.items()}
    for g, at in classes.items():
        tree = CountTree(points[g], sizes[at])
        for h, others in classes.items():
            if h < g or h * num > 2 * g * den:  # sizes too far apart
                continue
            folded = fold(points[h], g)
            if len(at) <= 2 * FANOUT and len(others) <= 2 * FANOUT:  # no more than a leaf or two: all bounds at once
                yield from _leaf(folded, others, points[g], at, sizes, labels, h == g, num, den)
                continue
            for q, i in enumerate(others.tolist()):
                j, bound = tree.search(folded[q], int(sizes[i]), num, den)
                j = at[j]
                fits = labels[j] != labels[i]
                if h == g:
                    fits &= j > i
                if fits.any():
                    yield i, j[fits], bound[fits]


def _leaf(a: np.ndarray, i: np.ndarray, b: np.ndarray, j: np.ndarray, sizes: np.ndarray, labels: np.ndarray, same: bool, num: int, den: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    m, n = sizes[i][:, None], sizes[j][None]
    fits = (labels[i][:, None] != labels[j][None]) & (np.minimum(m, n) * den >= np.maximum(m, n) * num)
    if same:
        fits &= np.arange(len(i))[:, None] < np.arange(len(j))[None]
    x, y = np.nonzero(fits)
    if not len(x):
        return
    shared = np.minimum(a[x], b[y])
    bound = np.where((shared >= FULL).any(1), np.iinfo(np.int32).max, shared.sum(1, dtype=np.int64))
    total = sizes[i[x]] + sizes[j[y]]
    fine = bound * (num + den) >= num * total
    x, y, bound = x[fine], y[fine], (bound / total)[fine]
    for q in np.unique(x).tolist():
        yield int(i[q]), j[y[x == q]], bound[x == q]


def forest(pairs: list[tuple[float, int, int]]) -> list[tuple[float, int, int]]:
    """Of (bound, label, label) those that join what earlier ones, by descending bound, have not."""
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for pair in sorted(pairs, key=lambda p: -p[0]):
        a, b = top(pair[1]), top(pair[2])
        if a != b:
            parent[a] = b
            out.append(pair)
    return out
