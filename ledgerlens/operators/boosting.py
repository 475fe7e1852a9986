"""One boosted-tree fit on a binned matrix: trees grown leaf by leaf, or symmetric trees on ordered residuals.

A fit is one group of a Spark job (see ``members``). Its input are byte codes, one row per labelled account: code 0 is a missing value, code c
above 0 the c-th bin. Both growers work on gradient and hessian sums per bin, one feature after the other, and return trees as flat arrays. Codes that
lie feature by feature (``byte_matrix``) are read where they are; memory grows with the rows by a few doubles each.
"""

from __future__ import annotations

import heapq
import os
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np

FEW_ROWS = 1_000  # leaves below this size count all features in one call
BINS = 254  # bins of present values; with the missing one a code is a byte


@dataclass
class Tree:
    """Nodes of one tree in the order of their making; ``left`` is -1 at leaves. ``cut`` is the last code that goes left."""

    feature: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    missing_left: list[bool] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    cover: list[float] = field(default_factory=list)

    def add(self, value: float, cover: float) -> int:
        for column, item in zip((self.feature, self.cut, self.missing_left, self.left, self.right, self.gain, self.value, self.cover),
                                (-1, 0, False, -1, -1, 0.0, value, cover)):
            column.append(item)
        return len(self.left) - 1

    def split(self, node: int, feature: int, cut: int, missing_left: bool, gain: float, left: int, right: int) -> None:
        self.feature[node], self.cut[node], self.missing_left[node], self.gain[node] = feature, cut, missing_left, gain
        self.left[node], self.right[node], self.value[node] = left, right, 0.0


def edges_of(values: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Upper edges of all bins but the last: halfway between neighbouring values, at quantiles where there are more values than bins."""
    known = np.sort(values[~np.isnan(values)])
    if not len(known):
        return np.empty(0)
    different = np.unique(known)
    if len(different) > bins:
        below = known[(np.arange(1, bins) * len(known)) // bins]
        at = np.unique(np.searchsorted(different, below))
    else:
        at = np.arange(1, len(different))
    at = at[at > 0]
    low, high = different[at - 1], different[at]
    middle = low + (high - low) / 2
    return np.unique(np.where(middle < high, middle, low))  # a middle that rounds up to the upper value would move it


def codes_of(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    return np.where(np.isnan(values), 0, np.searchsorted(edges, values, "left") + 1).astype(np.uint8)


def byte_matrix(features: int, rows: int) -> np.ndarray:
    """Byte codes feature by feature in a mapped file without a name: the system keeps of it in memory what there is room for."""
    if not features * rows:
        return np.zeros((features, rows), np.uint8)
    folder = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0]
    with tempfile.TemporaryFile(dir=folder if os.path.isdir(folder) else None) as file:
        file.truncate(features * rows)
        return np.asarray(np.memmap(file, np.uint8, "r+", shape=(features, rows)))


def sigmoid(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margin, -500, 500)))


def _shrunk(g, l1: float):
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0)


class LeafWise:
    """Second-order trees with L1 and L2 terms, always splitting the open leaf of highest gain."""

    def __init__(self, codes: np.ndarray, n_edges: np.ndarray, spec):
        self.spec, (self.n, self.f) = spec, codes.shape
        self.by_feature, self.b = np.ascontiguousarray(codes.T), int(n_edges.max(initial=0)) + 2
        self.cuts = np.arange(self.b - 1)[None, :] < n_edges[:, None]  # cut c sends codes 0 < code <= c + 1 left

    def sums(self, rows: np.ndarray, features: np.ndarray, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Rows, gradients and hessians per code of each of ``features``. Every sum is taken in the order of the rows."""
        k, whole = len(features), len(rows) == self.n
        weights = (None, *((g, h) if whole else (g[rows], h[rows])))
        if len(rows) < FEW_ROWS:  # all features in one call
            where = (self.by_feature[np.ix_(features, rows)] + np.arange(0, k * self.b, self.b)[:, None]).ravel()
            return np.stack([np.bincount(where, None if w is None else np.tile(w, k), k * self.b) for w in weights]).reshape(3, k, self.b)
        out = np.empty((3, k, self.b))
        for i, column in enumerate(features):  # the sums of one feature stay in the fastest cache
            code = (self.by_feature[column] if whole else self.by_feature[column].take(rows)).astype(np.intp)
            for j, w in enumerate(weights):
                out[j, i] = np.bincount(code, w, self.b)
        return out

    def best(self, sums: np.ndarray, total: np.ndarray, features: np.ndarray):
        """(gain, feature, cut, missing left) of the best split of a leaf, or None. Both ways for missing values are tried."""
        s, at_most, cuts = self.spec, np.cumsum(sums[:, :, 1:], axis=2), self.cuts[features]
        found = None
        for missing_left in (False, True):
            left = at_most + sums[:, :, :1] if missing_left else at_most
            ok = np.flatnonzero(cuts & (left[0] >= s.min_rows) & (total[0] - left[0] >= s.min_rows) & (left[2] >= s.min_hessian) & (
                total[2] - left[2] >= s.min_hessian))
            if len(ok):
                g, h = left[1].ravel()[ok], left[2].ravel()[ok]
                gain = _shrunk(g, s.l1) ** 2 / (h + s.l2) + _shrunk(total[1] - g, s.l1) ** 2 / (total[2] - h + s.l2)
                at = int(gain.argmax())
                gained = float(gain[at] - _shrunk(total[1], s.l1) ** 2 / (total[2] + s.l2))
                if gained > 1e-9 and (found is None or gained > found[0]):
                    found = (gained, int(features[ok[at] // (self.b - 1)]), int(ok[at] % (self.b - 1)) + 1, missing_left)
            if not sums[0, :, 0].any():
                break
        return found

    def grow(self, g: np.ndarray, h: np.ndarray, features: np.ndarray, used: np.ndarray) -> tuple[Tree, np.ndarray]:
        """A tree and the leaf value of every row; only ``used`` rows count."""
        s, tree, waiting = self.spec, Tree(), []
        values = np.zeros(self.n)

        def opened(rows: np.ndarray, sums: np.ndarray, depth: int) -> int:
            total = sums[:, 0].sum(axis=1)
            value = -s.rate * float(_shrunk(total[1], s.l1) / (total[2] + s.l2))
            node = tree.add(value, float(total[0]))
            values[rows] = value
            split = None if s.depth and depth == s.depth else self.best(sums, total, features)
            if split:
                heapq.heappush(waiting, (-split[0], node, split, rows, sums, depth))
            return node

        everything = np.arange(self.n)
        opened(everything, self.sums(everything[used], features, g, h), 0)
        leaves = 1
        while waiting and (not s.leaves or leaves < s.leaves):
            _, node, (gain, feature, cut, missing_left), rows, sums, depth = heapq.heappop(waiting)
            code = self.by_feature[feature].take(rows)
            goes_left = np.where(code == 0, missing_left, code <= cut)
            parts = rows[goes_left], rows[~goes_left]
            few = 0 if len(parts[0]) <= len(parts[1]) else 1
            counted = self.sums(parts[few][used[parts[few]]], features, g, h)
            both = (counted, sums - counted) if few == 0 else (sums - counted, counted)  # the sibling's sums by subtraction
            left, right = (opened(part, part_sums, depth + 1) for part, part_sums in zip(parts, both))
            tree.split(node, feature, cut, missing_left, gain, left, right)
            leaves += 1
        return tree, values


def leaf_wise(codes: np.ndarray, n_edges: np.ndarray, label: np.ndarray, weight: np.ndarray, spec, rng) -> Iterator[Tree | float]:
    """The starting margin and then one tree a round."""
    share = np.clip((weight * label).sum() / weight.sum(), 1e-6, 1 - 1e-6)
    margin = np.full(len(label), np.log(share / (1 - share)))
    yield float(margin[0])
    grower, n = LeafWise(codes, n_edges, spec), codes.shape[1]
    used, n_drawn = np.ones(len(label), bool), max(min(2, n), int(n * spec.feature_share + 0.5))  # two at least, as a single one decides by chance
    for number in range(spec.rounds):
        features = np.sort(rng.choice(n, n_drawn, replace=False))
        if spec.row_every and number % spec.row_every == 0:
            used = rng.random(len(label)) < spec.row_share
        p = sigmoid(margin)
        tree, values = grower.grow(weight * (p - label), weight * np.maximum(p * (1 - p), 1e-16), features, used)
        if spec.stops and len(tree.left) == 1:
            return
        margin += values
        yield tree


class Ordered:
    """Margins of ordered boosting over rows in a random order.

    Model k is made of the first 2**k rows and gives margins to twice as many. A row's residual comes from the largest model that ends
    before it, so that no leaf value behind it was made from its own label.
    """

    def __init__(self, label: np.ndarray, weight: np.ndarray, l2: float, rate: float):
        self.label, self.weight, self.l2, self.rate, n = label, weight, l2, rate, len(label)
        self.sizes = [1 << k for k in range(max(n - 1, 0).bit_length())]
        self.margins = [np.zeros(min(2 * size, n)) for size in self.sizes]
        self.whole = np.zeros(n)

    def unseen(self) -> np.ndarray:
        return np.concatenate([np.zeros(min(1, len(self.label))), *(m[size:] for m, size in zip(self.margins, self.sizes))])

    def _values(self, leaf: np.ndarray, margin: np.ndarray, n_leaves: int) -> np.ndarray:
        """One Newton step per leaf from the rows of ``margin``."""
        n = len(margin)
        p, w = sigmoid(margin), self.weight[:n]
        g = np.bincount(leaf[:n], w * (p - self.label[:n]), n_leaves)
        return -self.rate * g / (np.bincount(leaf[:n], w * p * (1 - p), n_leaves) + self.l2)

    def update(self, leaf: np.ndarray, n_leaves: int) -> np.ndarray:
        """Add a tree given as every row's leaf to all models; returns the values of the tree that is kept."""
        for size, margin in zip(self.sizes, self.margins):
            margin += self._values(leaf, margin[:size], n_leaves)[leaf[:len(margin)]]
        values = self._values(leaf, self.whole, n_leaves)
        self.whole += values[leaf]
        return values


def symmetric(codes: np.ndarray, n_edges: np.ndarray, label: np.ndarray, weight: np.ndarray, spec, rng) -> Iterator[Tree | float]:
    """Trees with one split a level, chosen on ordered residuals under random row weights; missing values are below all others."""
    yield 0.0
    order = rng.permutation(len(label))
    label, weight, (n, f) = label[order], weight[order], codes.shape
    b = int(n_edges.max(initial=0)) + 1  # cut c sends codes <= c + 1 left
    by_feature = byte_matrix(f, n)
    for own, column in zip(by_feature, codes.T):
        own[:] = (np.maximum(column, 1) - 1)[order]
    allowed = np.arange(b)[None, :] < n_edges[:, None]
    ordered = Ordered(label, weight, spec.l2, spec.rate)
    for number in range(spec.rounds):
        p = sigmoid(ordered.unseen())
        g = weight * (label - p)
        bag = (-np.log(1 - rng.random(n))) ** spec.temperature
        bagged = g * bag, weight * bag
        ahead = np.exp(np.log(n) - number * spec.rate)
        noise = spec.noise * np.sqrt(np.mean(g * g)) * ahead / (1 + ahead)
        leaf, splits = np.zeros(n, np.int64), []
        while len(splits) < spec.depth and allowed.any():
            place = np.cumsum(np.bincount(leaf) > 0)  # leaves without rows take part in no sum
            start, k = (place[leaf] - 1) * b, int(place[-1])
            num = den = 0
            sums = np.empty((2, k, f, b))
            for i, column in enumerate(by_feature):  # the sums of one feature stay in a fast cache
                where = start + column
                for x, v in zip(sums, bagged):
                    x[:, i] = np.bincount(where, v, k * b).reshape(k, b)
            left = [np.cumsum(x, axis=2) for x in sums]
            for gs, ws in (left, [x[:, :, -1:] - x for x in left]):
                mean = gs / (np.maximum(ws, 0) + spec.l2)
                num, den = num + (mean * gs).sum(axis=0), den + (mean * mean * np.maximum(ws, 0)).sum(axis=0)
            score = np.where(allowed, num / np.sqrt(den + 1e-100) + rng.normal(size=(f, b)) * noise, -np.inf)
            at = int(score.argmax())
            splits.append((at // b, at % b + 1, float(num.flat[at])))
            leaf = 2 * leaf + (by_feature[at // b] > at % b)
        n_leaves = 1 << len(splits)
        values = ordered.update(leaf, n_leaves)
        covers = np.maximum(np.bincount(leaf, minlength=n_leaves), 1e-3)  # a leaf without rows keeps a path weight above zero
        yield _complete(splits, values, covers)


def _complete(splits: list[tuple[int, int, float]], values: np.ndarray, covers: np.ndarray) -> Tree:
    """The symmetric tree as flat nodes, level by level: node i has the children 2 i + 1 and 2 i + 2."""
    tree, levels = Tree(), [covers]
    for _ in splits:
        levels.append(levels[-1].reshape(-1, 2).sum(axis=1))
    for cover in levels[::-1]:
        for c in cover:
            tree.add(0.0, float(c))
    inner = (1 << len(splits)) - 1
    for node in range(inner):
        feature, cut, gain = splits[(node + 1).bit_length() - 1]
        tree.split(node, feature, cut, True, gain, 2 * node + 1, 2 * node + 2)
    tree.value[inner:] = values.tolist()
    return tree
