"""An R-tree over count vectors, and the join of its points by a bound on overlap.

A point is a set's number of elements in each of a few hash groups. Two sets share at most the sum over groups of the smaller
of their counts. For two boxes the sum of the smaller upper corners bounds every pair in them. Boxes are kept on folded
groups (FOLD neighbours added up); pairs of points are tested on folded groups first and then on all of them.

Sets of which the parities of finer groups are known differ in at least as many elements as their parities do in groups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

LEAF = 32
FAN = 8
FOLD = 4
#: Bytes of parities that are compared at a time.
ROOM = 16 << 20


def least_shared(a, b, percent: int):
    """Elements that sets of sizes a and b have to share for a Jaccard similarity of percent / 100."""
    return -((-percent * (a + b)) // (100 + percent))


def _packed_order(sizes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Points in leaf order: by size, and among about equal sizes by the group that varies most."""
    order = np.argsort(sizes, kind="stable")
    run = LEAF * max(1, int(np.sqrt(len(order) / LEAF)))
    for begin in range(0, len(order), run):
        part = order[begin : begin + run]
        axis = counts[part].var(axis=0).argmax()
        order[begin : begin + run] = part[np.argsort(counts[part, axis], kind="stable")]
    return order


class RTree:
    def __init__(self, sizes: np.ndarray, counts: np.ndarray) -> None:
        folded = counts.reshape(len(counts), -1, FOLD).sum(axis=2, dtype=np.int64)
        self.order = _packed_order(sizes, folded)
        self.sizes, self.counts, self.fine = sizes[self.order].astype(np.int64), folded[self.order], counts[self.order]
        cuts = np.arange(0, len(sizes), LEAF)
        # Levels from the leaves up: upper corners, smallest and largest size of each box.
        self.levels = [
            (
                np.maximum.reduceat(self.counts, cuts),
                np.minimum.reduceat(self.sizes, cuts),
                np.maximum.reduceat(self.sizes, cuts),
            )
        ]
        while len(self.levels[-1][0]) > FAN:
            high, least, most = self.levels[-1]
            cuts = np.arange(0, len(high), FAN)
            self.levels.append(
                (np.maximum.reduceat(high, cuts), np.minimum.reduceat(least, cuts), np.maximum.reduceat(most, cuts))
            )

    def points(self, leaf: int) -> slice:
        return slice(leaf * LEAF, min((leaf + 1) * LEAF, len(self.sizes)))


def _boxes_meet(a, i: np.ndarray, b, j: np.ndarray, percent: int) -> np.ndarray:
    (high_a, least_a, most_a), (high_b, least_b, most_b) = a, b
    out = np.empty(len(i), dtype=bool)
    for begin in range(0, len(i), 4096):
        x, y = i[begin : begin + 4096], j[begin : begin + 4096]
        shared = np.minimum(np.minimum(high_a[x], high_b[y]).sum(axis=1), np.minimum(most_a[x], most_b[y]))
        need = least_shared(least_a[x], least_b[y], percent)
        larger = np.maximum(least_a[x], least_b[y])
        smaller = np.minimum(most_a[x], most_b[y])
        out[begin : begin + 4096] = (shared >= need) & (100 * smaller >= percent * larger)
    return out


def join(a: RTree, b: RTree, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (into the arrays the trees were made of) whose bound allows the similarity, leaf by leaf.

    For a tree with itself (a is b) each unordered pair of different points comes once.
    """
    same = a is b
    top_a, top_b = len(a.levels) - 1, len(b.levels) - 1
    i, j = (x.ravel() for x in np.indices((len(a.levels[top_a][0]), len(b.levels[top_b][0]))))
    if same:
        i, j = i[i <= j], j[i <= j]
    while True:
        meet = _boxes_meet(a.levels[top_a], i, b.levels[top_b], j, percent)
        i, j = i[meet], j[meet]
        if top_a == 0 and top_b == 0:
            break
        if top_a >= top_b:
            i, j, top_a = *_opened(i, j, len(a.levels[top_a - 1][0])), top_a - 1
        if top_b > top_a or (same and top_b > 0 and top_b > top_a):
            j, i, top_b = *_opened(j, i, len(b.levels[top_b - 1][0])), top_b - 1
        if same and top_a == top_b:
            i, j = i[i <= j], j[i <= j]
    for x, y in zip(i.tolist(), j.tolist(), strict=True):
        p, q = a.points(x), b.points(y)
        shared = np.minimum(a.counts[p][:, None, :], b.counts[q][None, :, :]).sum(axis=2)
        fits = shared >= least_shared(a.sizes[p][:, None], b.sizes[q][None, :], percent)
        if same and x == y:
            fits = np.triu(fits, 1)
        u, v = np.nonzero(fits)
        if len(u):
            u, v = u + p.start, v + q.start
            shared = np.minimum(a.fine[u], b.fine[v]).sum(axis=1, dtype=np.int64)
            fits = shared >= least_shared(a.sizes[u], b.sizes[v], percent)
            if fits.any():
                yield a.order[u[fits]], b.order[v[fits]]


def _opened(i: np.ndarray, j: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Each box i replaced by its boxes one level down."""
    child = (i[:, None] * FAN + np.arange(FAN)).ravel()
    other = np.repeat(j, FAN)
    there = child < count
    return child[there], other[there]


class Parities:
    """Parities of the counts in a power of two of groups (at least 64) per set, one bit each, the lowest groups first."""

    def __init__(self, rows: list[bytes]) -> None:
        self.widths = np.array([len(r) for r in rows], dtype=np.int64)
        self.at, self.tables = np.empty(len(rows), dtype=np.int64), {}
        for width in np.unique(self.widths).tolist():
            own = np.flatnonzero(self.widths == width)
            self.at[own] = np.arange(len(own))
            self.tables[width] = np.frombuffer(b"".join([rows[k] for k in own]), np.uint64).reshape(len(own), -1)

    def differences(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """In how many groups the sets i and j differ; more groups are first added up to as many as the other has."""
        out = np.empty(len(i), dtype=np.int64)
        swap = self.widths[i] > self.widths[j]
        i, j = np.where(swap, j, i), np.where(swap, i, j)
        for narrow, wide in set(zip(self.widths[i].tolist(), self.widths[j].tolist(), strict=True)):
            places = np.flatnonzero((self.widths[i] == narrow) & (self.widths[j] == wide))
            step = max(1, ROOM // wide)
            for begin in range(0, len(places), step):
                part = places[begin : begin + step]
                a, b = self.tables[narrow][self.at[i[part]]], self.tables[wide][self.at[j[part]]]
                while b.shape[1] > a.shape[1]:
                    half = b.shape[1] // 2
                    b = b[:, :half] ^ b[:, half:]
                out[part] = np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)
        return out
