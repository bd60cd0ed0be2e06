"""Batch attribution of tree ensembles (path-dependent Shapley values), one walk per tree.

A leaf contributes ``value`` when the row meets all conditions on its path; a feature that is left out
counts with the share of training rows that met its conditions. For such a product the Shapley weights
are the integral over t in [0, 1] of the product of ``met * t + share * (1 - t)`` over the other
features, a polynomial that a short Gauss-Legendre rule integrates exactly.

The walk carries the values of that product at the rule's points: down, every edge multiplies its own
factor in and divides out that of the last edge above with the same feature; up, the products of the
leaves are summed. An edge's share of its feature's attribution needs its own factor and its subtree's sum
alone, so a tree costs as much as it has edges, for a whole batch of rows and a level of nodes at once.
"""

from __future__ import annotations

import numpy as np

CELLS = 1 << 18  # numbers per array, so that a step stays in a core's cache: the rows of a step follow from it


class Forest:
    """Trees as arrays over their nodes, parents before children.

    ``parent`` is -1 at a root; ``left`` tells whether a node is met by values up to its parent's ``cut``;
    ``share`` is the part of the parent's training rows; ``value`` counts in leaves only.
    """

    def __init__(self, parent, feature, cut, left, share, value, width: int) -> None:
        parent = np.asarray(parent, dtype=np.int64)
        n = len(parent)
        depth, at = np.zeros(n, dtype=np.int64), parent
        while (at >= 0).any():
            depth += at >= 0
            at = np.where(at >= 0, parent[at], -1)
        order = np.argsort(depth, kind="stable")  # level by level
        place = np.empty(n, dtype=np.int64)
        place[order] = np.arange(n)
        self.parent = np.where(parent[order] >= 0, place[parent[order]], -1)
        self.levels = np.searchsorted(depth[order], np.arange(int(depth.max(initial=0)) + 2))
        self.cut, self.left = np.asarray(cut, dtype=float)[order], np.asarray(left, dtype=bool)[order]
        self.value, self.width = np.asarray(value, dtype=float)[order], width
        self.value[self.parent[self.parent >= 0]] = 0.0
        # an edge's feature is its parent's; the last edge above with the same one is its prior
        self.edge = np.where(self.parent >= 0, np.asarray(feature, dtype=np.int64)[order][self.parent], -1)
        self.prior, at = np.full(n, -1), self.parent
        while (at >= 0).any():
            hit = (self.prior < 0) & (at >= 0) & (self.edge[at] == self.edge)
            self.prior[hit] = at[hit]
            at = np.where(at >= 0, self.parent[at], -1)
        self.share = np.asarray(share, dtype=float)[order].copy()
        reach, distinct = np.ones(n), np.zeros(n, dtype=np.int64)
        for low, high in zip(self.levels[1:-1], self.levels[2:]):
            here, above, prior = slice(low, high), self.parent[low:high], self.prior[low:high]
            reach[here] = reach[above] * self.share[here]
            distinct[here] = distinct[above] + (prior < 0)
            self.share[here] *= np.where(prior >= 0, self.share[prior], 1.0)
        self.base = float((self.value * reach).sum())
        points, weights = np.polynomial.legendre.leggauss(max(1, (int(distinct.max(initial=0)) + 1) // 2))
        self.points, self.weights = (points + 1) / 2, weights / 2
        edges = np.flatnonzero(self.parent >= 0)
        self.by_feature = edges[np.argsort(self.edge[edges], kind="stable")]
        self.heads = np.flatnonzero(np.diff(self.edge[self.by_feature], prepend=-2))

    def attribute(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros((len(rows), self.width))
        if not len(self.by_feature):
            return out
        step = max(1, CELLS // (len(self.parent) * len(self.points)))
        for at in range(0, len(rows), step):
            part = self._walk(np.ascontiguousarray(rows[at : at + step].T))
            sums = np.add.reduceat(part[self.by_feature], self.heads, axis=0)
            out[at : at + step, self.edge[self.by_feature[self.heads]]] = sums.T
        return out

    def _walk(self, x: np.ndarray) -> np.ndarray:
        """What every edge adds to its feature, for columns of rows."""
        n, t, k = len(self.parent), self.points[:, None, None], x.shape[1]
        met = np.ones((n, k), dtype=bool)
        product = np.ones((len(t), n, k))
        factor = np.ones((len(t), n, k))
        for low, high in zip(self.levels[1:-1], self.levels[2:]):
            here, above, prior = slice(low, high), self.parent[low:high], self.prior[low:high]
            meets = (x[self.edge[here]] <= self.cut[above][:, None]) == self.left[here][:, None]
            again = prior >= 0
            meets[again] &= met[prior[again]]
            met[here] = meets
            share = self.share[here][:, None]
            own = np.where(meets, t + share * (1 - t), share * (1 - t))
            factor[:, here] = own
            product[:, here] = product[:, above] * own
            product[:, low + np.flatnonzero(again)] /= factor[:, prior[again]]
        total = product
        total *= self.value[:, None]
        for low, high in zip(self.levels[-2:0:-1], self.levels[:1:-1]):
            pairs = self.parent[low:high]
            heads = np.flatnonzero(np.diff(pairs, prepend=-1))
            total[:, pairs[heads]] += np.add.reduceat(total[:, low:high], heads, axis=1)
        gain = (met - self.share[:, None]) / factor
        again = np.flatnonzero(self.prior >= 0)
        change = gain.copy()
        change[:, again] -= gain[:, self.prior[again]]
        change *= total
        return np.einsum("p,pnk->nk", self.weights, change)
