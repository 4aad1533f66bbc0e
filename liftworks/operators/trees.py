"""Fitted regression trees as small arrays, evaluated batch-wise inside Spark tasks.

A tree has some dozen nodes. Scores and contributions run over Arrow batches.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Node:
    feature: int  # -1 for a leaf
    threshold: float
    left: int
    right: int
    value: float
    cover: float  # hessian weight that reaches the node
    missing_left: bool = False  # where rows without the feature go


@dataclass(frozen=True)
class Tree:
    nodes: tuple[Node, ...]


def predict(tree: Tree, x: np.ndarray) -> np.ndarray:
    """Leaf values of a batch of rows; NaN is missing."""
    at = np.zeros(len(x), dtype=np.int64)
    feature, threshold, left, right, missing_left = (
        np.array([getattr(n, s) for n in tree.nodes])
        for s in ("feature", "threshold", "left", "right", "missing_left")
    )
    rows = np.arange(len(x))
    while (inner := feature[at] >= 0).any():
        go = rows[inner]
        value, node = x[go, feature[at[go]]], at[go]
        below = (value <= threshold[node]) | (np.isnan(value) & missing_left[node])
        at[go] = np.where(below, left[node], right[node])
    return np.array([n.value for n in tree.nodes])[at]


@dataclass(frozen=True)
class Leaf:
    """A leaf with, per feature on its path, what is let through and the cover share of the path."""

    value: float
    used: np.ndarray
    above: np.ndarray
    upto: np.ndarray
    missing: np.ndarray  # whether rows without the feature pass
    share: np.ndarray
    table: np.ndarray | None  # Shapley values by which features let a row pass, if there are few

    @property
    def expected(self) -> float:
        return self.value * math.prod(self.share.tolist())


#: Features on a path up to which a leaf's values are tabulated once for all rows.
TABLED = 6


def leaves(tree: Tree) -> list[Leaf]:
    out: list[Leaf] = []
    open_nodes: list[tuple[int, dict]] = [(0, {})]
    while open_nodes:
        at, bounds = open_nodes.pop()
        node = tree.nodes[at]
        if node.feature < 0:
            k = len(bounds)
            lo, hi, missing, share = (np.array([b[i] for b in bounds.values()], dtype=float) for i in range(4))
            used = np.array(list(bounds), dtype=int)
            table = None
            if k <= TABLED:
                passes = (np.arange(1 << k)[:, None] >> np.arange(k) & 1).astype(bool)
                table = leaf_values(node.value, share, passes)
            out.append(Leaf(node.value, used, lo, hi, missing > 0, share, table))
            continue
        above, upto, missing, share = bounds.get(node.feature, (-math.inf, math.inf, True, 1.0))
        for child, lo, hi, lets in (
            (node.right, max(above, node.threshold), upto, not node.missing_left),
            (node.left, above, min(upto, node.threshold), node.missing_left),
        ):
            part = tree.nodes[child].cover / node.cover if node.cover else 0.0
            open_nodes.append((child, bounds | {node.feature: (lo, hi, missing and lets, share * part)}))
    return out


def leaf_values(value: float, share: np.ndarray, passes: np.ndarray) -> np.ndarray:
    """Shapley values of a leaf for rows of ``passes`` (row, feature on the path).

    A leaf's game is a product over its features: 0/1 whether the row passes if the feature is known, the
    cover share if not. The Shapley value needs the sizes of coalitions only: the coefficients of the
    product of ``share + pass * t``. One pass extends the product by all features, then each feature is
    taken out of it again by division, so a path of k features costs k**2 steps whatever the depth.
    """
    n, k = passes.shape
    if not k:
        return np.zeros((n, 0))
    sizes = np.zeros((k + 1, n))
    sizes[0] = 1.0
    for j in range(k):
        sizes[1 : j + 2] = sizes[1 : j + 2] * share[j] + sizes[: j + 1] * passes[:, j]
        sizes[0] *= share[j]
    weights = [math.exp(math.lgamma(s + 1) + math.lgamma(k - s) - math.lgamma(k + 1)) for s in range(k)]
    out = np.zeros((n, k))
    for i in range(k):
        z, on = share[i], passes[:, i]
        rest, reach = np.zeros(n), np.zeros(n)
        for s in range(k - 1, -1, -1):  # with the feature: from the highest size down
            rest = sizes[s + 1] - z * rest
            reach += weights[s] * rest
        if z > 0:  # without it the product is a multiple; a share of 0 leaves nothing of it
            off = sum(w * c for w, c in zip(weights, sizes)) / z
            reach = np.where(on, reach, off)
        else:
            reach = np.where(on, reach, 0.0)
        out[:, i] = value * (on - z) * reach
    return out


def add_contributions(found: Sequence[Leaf], x: np.ndarray, phi: np.ndarray) -> float:
    """Add a tree's Shapley values of a batch to ``phi``; gives the expected value."""
    for leaf in found:
        inside = x[:, leaf.used]
        passed = ((inside > leaf.above) & (inside <= leaf.upto)) | (np.isnan(inside) & leaf.missing)
        if leaf.table is not None:
            phi[:, leaf.used] += leaf.table[passed @ (1 << np.arange(len(leaf.used)))]
            continue
        packed = np.packbits(passed, axis=1)
        _, first, same = np.unique(packed, axis=0, return_index=True, return_inverse=True)
        phi[:, leaf.used] += leaf_values(leaf.value, leaf.share, passed[first])[same.ravel()]
    return sum(leaf.expected for leaf in found)


def contributions(tree: Tree, x: np.ndarray) -> tuple[np.ndarray, float]:
    """Shapley values of a batch on the tree's path-dependent game, and the expected value."""
    phi = np.zeros(x.shape)
    return phi, add_contributions(leaves(tree), x, phi)


# --- growing ----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Penalty:
    """What a split must satisfy and how leaves shrink."""

    alpha: float = 0.0
    ridge: float = 1.0
    min_child_weight: float = 0.0
    monotone: tuple[int, ...] = ()

    def step(self, g, h):
        return -np.sign(g) * np.maximum(np.abs(g) - self.alpha, 0.0) / np.maximum(h + self.ridge, 1e-300)

    def worth(self, g, h):
        return np.maximum(np.abs(g) - self.alpha, 0.0) ** 2 / np.maximum(h + self.ridge, 1e-300)


class Grower:
    """A tree that grows level by level from histograms of gradients over binned features.

    Histograms are (node, used feature, bin, what): rows, gradients, hessians. The last bin holds the rows
    without the feature. Only ``wanted`` nodes are summed: of two siblings the one with fewer rows; the
    other is the parent's histogram less this one. Row counts are whole numbers, so a bin without rows
    is told exactly and holds no rounding.
    """

    def __init__(self, cuts: Sequence[np.ndarray], used: Sequence[int], penalty: Penalty, bins: int):
        self.cuts, self.used, self.penalty, self.bins = cuts, list(used), penalty, bins
        self.feature, self.bin, self.left, self.right = [-1], [0], [-1], [-1]
        self.missing_left = [False]
        self.sums, self.bounds = [(0.0, 0.0)], [(-math.inf, math.inf)]
        self.open, self.wanted = [0], [0]
        self._above: dict[int, tuple[int, np.ndarray]] = {}  # node to be derived: sibling, parent's histogram

    @property
    def shape(self) -> tuple[int, int, int, int]:
        return len(self.wanted), len(self.used), self.bins + 1, 3

    def slots(self) -> np.ndarray:
        """Place of each node among the wanted ones, -1 for others."""
        out = np.full(len(self.feature), -1, dtype=np.int64)
        out[self.wanted] = np.arange(len(self.wanted))
        return out

    def step(self, bins: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Nodes of rows one level on; ``bins`` is (feature, row). A row goes left if its bin is at most the
        node's, or if it has no value and the node says so."""
        feature, cut, left, right = map(np.array, (self.feature, self.bin, self.left, self.right))
        missing_left = np.array(self.missing_left)
        go = np.flatnonzero(feature[at] >= 0)
        node = at[go]
        value = bins[feature[node], go]
        below = (value <= cut[node]) | ((value == self.bins) & missing_left[node])
        out = at.copy()
        out[go] = np.where(below, left[node], right[node])
        return out

    def place(self, bins: np.ndarray) -> np.ndarray:
        """Leaf of each row so far."""
        at = np.zeros(bins.shape[1], dtype=np.int64)
        inner = np.array(self.feature) >= 0
        while inner[at].any():
            at = self.step(bins, at)
        return at

    def grow(self, sums: np.ndarray) -> None:
        """Split the open nodes, given the histograms of the wanted ones."""
        tables = dict(zip(self.wanted, sums))
        for node, (sibling, parent) in self._above.items():
            table = parent - tables[sibling]
            table[table[:, :, 0] == 0] = 0.0
            tables[node] = table
        self._above, following, wanted = {}, [], []
        for node in self.open:
            split = self._best(node, tables[node])
            if split is None:
                continue
            f, cut, missing_left, sides = split
            children = [self._child(span, side) for span, side in zip(self._spans(node, f, cut, sides), sides)]
            self.feature[node], self.bin[node], self.missing_left[node] = f, cut, missing_left
            self.left[node], self.right[node] = children
            following += children
            few, many = children if sides[0][0] <= sides[1][0] else children[::-1]
            wanted.append(few)
            self._above[many] = (few, tables[node])
        self.open, self.wanted = following, wanted

    def _child(self, span, side) -> int:
        for values, x in (
            (self.feature, -1), (self.bin, 0), (self.left, -1), (self.right, -1), (self.missing_left, False),
            (self.bounds, span), (self.sums, (float(side[1]), float(side[2]))),
        ):
            values.append(x)
        return len(self.feature) - 1

    def _spans(self, node: int, f: int, cut: int, sides):
        """Bounds of the children's values."""
        p, (low, high) = self.penalty, self.bounds[node]
        turn = p.monotone[f] if p.monotone and cut < len(self.cuts[f]) else 0
        if not turn:
            return (low, high), (low, high)
        middle = sum(float(np.clip(p.step(g, h), low, high)) for _, g, h in sides) / 2
        return ((low, middle), (middle, high)) if turn > 0 else ((middle, high), (low, middle))

    def _best(self, node: int, table: np.ndarray):
        """(feature, bin, whether missing goes left, both sides' sums) of the best split of a node."""
        p = self.penalty
        total = table[0].sum(axis=0)
        self.sums[node] = (float(total[1]), float(total[2]))
        present = np.cumsum(table[:, :-1], axis=1)
        missing = table[:, -1][:, None]
        left = np.stack([present, present + missing], axis=2)  # missing goes right, or left
        right = total - left
        left_g, left_h, right_g, right_h = left[..., 1], left[..., 2], right[..., 1], right[..., 2]
        gain = p.worth(left_g, left_h) + p.worth(right_g, right_h) - p.worth(total[1], total[2])
        least = max(p.min_child_weight, 1e-12)
        fits = (left[..., 0] > 0) & (right[..., 0] > 0) & (left_h >= least) & (right_h >= least)
        fits[..., 1] &= table[:, -1, 0][:, None] > 0  # else both are the same
        low, high = self.bounds[node]
        for k, f in enumerate(self.used):
            n = len(self.cuts[f])
            fits[k, n + 1 :] = False
            fits[k, n, 1] = False  # at the last bin all present rows are left, so missing ones go right
            if p.monotone and p.monotone[f]:
                steps = [np.clip(p.step(g[k, :n], h[k, :n]), low, high) for g, h in ((left_g, left_h), (right_g, right_h))]
                fits[k, :n] &= p.monotone[f] * (steps[1] - steps[0]) >= 0
        gain = np.where(fits, gain, -np.inf)
        best = gain.max(initial=-np.inf)
        if not best > 1e-9 * (1.0 + abs(p.worth(total[1], total[2]))):
            return None
        # equal gains up to rounding: the first feature, bin and side
        k, cut, side = map(int, np.argwhere(gain >= best - 1e-9 * abs(best))[0])
        sides = left[k, cut, side], right[k, cut, side]
        # nothing missing here: later rows without a value follow the heavier side
        missing_left = bool(side) if table[k, -1, 0] > 0 else bool(sides[0][2] >= sides[1][2])
        return self.used[k], cut, missing_left, sides

    def values(self, rate: float) -> np.ndarray:
        """Leaf values, 0 for inner nodes."""
        return np.array([
            rate * float(np.clip(self.penalty.step(*s), *b)) if f < 0 else 0.0
            for f, s, b in zip(self.feature, self.sums, self.bounds)
        ])

    def tree(self, rate: float) -> Tree:
        nodes = []
        for i, (f, value) in enumerate(zip(self.feature, self.values(rate).tolist())):
            threshold = 0.0
            if f >= 0:
                threshold = float(self.cuts[f][self.bin[i]]) if self.bin[i] < len(self.cuts[f]) else math.inf
            nodes.append(Node(f, threshold, self.left[i], self.right[i], value, self.sums[i][1], self.missing_left[i]))
        return Tree(tuple(nodes))


def histograms(bins: np.ndarray, slot: np.ndarray, used: Sequence[int], shape, g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Sums of rows by (slot, used feature, bin); ``bins`` is (feature, row), rows of slot -1 are left out.

    Each feature fills its own slice of slots times bins, so the work grows with rows times features.
    """
    out = np.zeros(shape)
    slots, _, width, _ = shape
    kept = np.flatnonzero(slot >= 0)
    base, g, h = slot[kept] * width, g[kept], h[kept]
    for k, f in enumerate(used):
        cell = base + bins[f, kept]
        for what, weights in enumerate((None, g, h)):
            out[:, k, :, what] = np.bincount(cell, weights, slots * width).reshape(slots, width)
    return out
