"""Fitted members as a flat table of nodes: scoring and exact contributions in Arrow batches, without a fit.

The table has one row per node: model, tree, node, feature, cut, missing_left, left_node, right_node, gain, value, cover. Values at most ``cut`` go left,
missing ones where ``missing_left`` says; leaves have no feature. Tree -1 is the starting margin. A model's size is bounded by its rounds and leaves,
never by the data, so the table is read by the driver and broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

import numpy as np

NODES = ("model string, tree int, node int, feature string, cut double, missing_left boolean, left_node int, right_node int, "
         "gain double, value double, cover double")
CELLS = 1 << 18  # rows x trees, or rows x leaves x features, worked on at a time


class Forest:
    """The nodes of one model as arrays, children by place."""

    def __init__(self, nodes, features: Sequence[str]):
        """``nodes`` is a pandas frame with the columns of NODES."""
        base = nodes.tree < 0
        self.base, nodes = float(nodes.value[base].sum()), nodes[~base].sort_values(["tree", "node"]).reset_index(drop=True)
        places, inner = {name: i for i, name in enumerate(features)}, nodes.feature.notna().to_numpy()
        tree, own = nodes.tree.to_numpy(), np.arange(len(nodes))
        self.roots = np.flatnonzero(nodes.node.to_numpy() == 0)
        start = self.roots[np.searchsorted(tree[self.roots], tree)] if len(nodes) else own
        self.inner, self.n_features = inner, len(features)
        self.feature = np.array([places[name] if ok else 0 for name, ok in zip(nodes.feature, inner)], np.int64)
        self.cut, self.missing = np.where(inner, nodes.cut, np.inf), nodes.missing_left.to_numpy(bool) & inner
        # A leaf is its own child, so that a walk may go on below it.
        self.left = np.where(inner, start + nodes.left_node.fillna(0).to_numpy(np.int64), own)
        self.right = np.where(inner, start + nodes.right_node.fillna(0).to_numpy(np.int64), own)
        self.value, self.cover = nodes.value.to_numpy(float), nodes.cover.to_numpy(float)

    @cached_property
    def depth(self) -> int:
        level, depth = self.roots, 0
        while len(level := level[self.inner[level]]):
            level, depth = np.concatenate([self.left[level], self.right[level]]), depth + 1
        return depth

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Sum of the leaf values of every row, walking all trees level by level."""
        out, step = np.full(len(x), self.base), max(1, CELLS // max(1, len(self.roots)))
        for at in range(0, len(x), step):
            part = x[at:at + step]
            node, rows = np.repeat(self.roots[None, :], len(part), axis=0), np.arange(len(part))[:, None]
            for _ in range(self.depth):
                value = part[rows, self.feature[node]]
                goes_left = (value <= self.cut[node]) | (np.isnan(value) & self.missing[node])
                node = np.where(goes_left, self.left[node], self.right[node])
            out[at:at + step] += self.value[node].sum(axis=1)
        return out

    @cached_property
    def paths(self) -> dict[int, list[np.ndarray]]:
        """Leaves by the number of different features above them: their features, bounds, way of missing values, cover shares and values."""
        found: dict[int, list[tuple]] = {}
        waiting = [(root, {}) for root in self.roots.tolist()]
        while waiting:
            node, above = waiting.pop()
            if not self.inner[node]:
                found.setdefault(len(above), []).append((list(above), list(above.values()), self.value[node]))
                continue
            name, cut, missing = int(self.feature[node]), float(self.cut[node]), bool(self.missing[node])
            low, high, misses, share = above.get(name, (-np.inf, np.inf, True, 1.0))
            left, right = int(self.left[node]), int(self.right[node])
            waiting.append((left, {**above, name: (low, min(high, cut), misses and missing, share * self.cover[left] / self.cover[node])}))
            waiting.append((right, {**above, name: (max(low, cut), high, misses and not missing, share * self.cover[right] / self.cover[node])}))
        return {size: [np.array([f for f, _, _ in leaves], np.int64).reshape(len(leaves), size),
                       *(np.array([[c[i] for c in conditions] for _, conditions, _ in leaves], kind).reshape(len(leaves), size)
                         for i, kind in enumerate((float, float, bool, float))),
                       np.array([v for _, _, v in leaves])] for size, leaves in found.items()}

    def expected(self) -> float:
        """Mean margin under the cover shares: what all contributions add up from."""
        return self.base + sum(float((share.prod(axis=1) * value).sum()) for _, _, _, _, share, value in self.paths.values())

    def contributions(self, x: np.ndarray) -> np.ndarray:
        """Shapley values (rows x features) of the margin, features outside a coalition following the cover shares.

        A leaf is a product game over the features above it: a feature in the coalition contributes whether the row meets its condition,
        one outside its share. The mean over all orders is the integral over t from 0 to 1 of the product of share + t (met - share) over
        the other features, a polynomial that Gauss-Legendre nodes integrate exactly.
        """
        out = np.zeros((len(x), self.n_features))
        for size, (feature, low, high, missing, share, value) in self.paths.items():
            if not size:
                continue
            points, weights = np.polynomial.legendre.leggauss((size + 1) // 2)
            leaves = max(1, CELLS // (size * max(1, len(x))))
            for at in range(0, len(value), leaves):
                part = slice(at, at + leaves)
                given = x[:, feature[part]]
                met = ((given > low[part]) & (given <= high[part])) | (np.isnan(given) & missing[part])
                total = 0.0
                for point, weight in zip((points + 1) / 2, weights / 2):
                    factor = share[part] + point * (met - share[part])
                    total = total + weight * factor.prod(axis=2, keepdims=True) / factor
                parts = value[part][:, None] * (met - share[part]) * total
                where = np.arange(len(x))[:, None, None] * self.n_features + feature[part][None]
                out += np.bincount(where.ravel(), parts.ravel(), out.size).reshape(out.shape)
        return out
