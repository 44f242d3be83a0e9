"""Boosted regression trees on binned features for the logistic loss, and their paths as rules. Numpy only, deterministic."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Node:
    """x[feature] <= threshold goes left; a leaf has no feature."""

    value: float = 0.0
    feature: int = -1
    threshold: float = 0.0
    left: Node | None = None
    right: Node | None = None


@dataclass
class Boosted:
    start: float
    rate: float
    trees: list[Node] = field(default_factory=list)

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        for t in self.trees:
            out += self.rate * apply(t, x)
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.margin(x))


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


def apply(node: Node, x: np.ndarray) -> np.ndarray:
    if node.feature < 0:
        return np.full(len(x), node.value)
    go = x[:, node.feature] <= node.threshold
    out = np.empty(len(x))
    out[go], out[~go] = apply(node.left, x[go]), apply(node.right, x[~go])
    return out


def cut_points(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """Midpoints between neighbouring quantiles of each feature."""
    cuts = []
    for j in range(x.shape[1]):
        q = np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)))
        cuts.append((q[:-1] + q[1:]) / 2)
    return cuts


def _grow(codes, cuts, g, h, rows, depth, min_leaf, l2) -> Node:
    G, H = g[rows].sum(), h[rows].sum()
    node = Node(value=-G / (H + l2))
    if depth == 0 or len(rows) < 2 * min_leaf:
        return node
    best, pick = 1e-6, None
    for j, cut in enumerate(cuts):
        if not len(cut):
            continue
        c = codes[rows, j]
        k = len(cut) + 1
        gl, hl, nl = (np.cumsum(np.bincount(c, w, k))[:-1] for w in (g[rows], h[rows], None))
        gain = gl**2 / (hl + l2) + (G - gl) ** 2 / (H - hl + l2) - G**2 / (H + l2)
        gain[(nl < min_leaf) | (len(rows) - nl < min_leaf)] = -1
        at = int(np.argmax(gain))
        if gain[at] > best:
            best, pick = gain[at], (j, at)
    if pick is None:
        return node
    j, at = pick
    go = codes[rows, j] <= at
    node.feature, node.threshold = j, float(cuts[j][at])
    node.left = _grow(codes, cuts, g, h, rows[go], depth - 1, min_leaf, l2)
    node.right = _grow(codes, cuts, g, h, rows[~go], depth - 1, min_leaf, l2)
    return node


def fit_boosted(x, y, trees=40, depth=3, rate=0.2, bins=32, min_leaf=10, l2=1.0, seed=0, sample=0.7, features=1.0) -> Boosted:
    """Each tree sees a seeded share of rows and features."""
    rng = np.random.default_rng(seed)
    p = np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3)
    model = Boosted(float(np.log(p / (1 - p))), rate)
    if len(y) < 2 * min_leaf or y.min() == y.max():
        return model
    cuts = cut_points(x, bins)
    codes = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
    z = np.full(len(y), model.start)
    for _ in range(trees):
        p = sigmoid(z)
        rows = np.flatnonzero(rng.random(len(y)) < sample)
        used = [c if rng.random() < features else c[:0] for c in cuts]
        if len(rows) < 2 * min_leaf:
            rows = np.arange(len(y))
        t = _grow(codes, used, p - y, np.maximum(p * (1 - p), 1e-6), rows, depth, min_leaf, l2)
        model.trees.append(t)
        z += rate * apply(t, x)
    return model


#: A condition: feature, threshold, and whether x <= threshold.
Condition = tuple[int, float, bool]


def paths(node: Node, above: tuple[Condition, ...] = ()) -> list[tuple[Condition, ...]]:
    """The conjunction that leads to each node below the root, inner nodes too."""
    out = [above] if above else []
    if node.feature >= 0:
        out += paths(node.left, (*above, (node.feature, node.threshold, True)))
        out += paths(node.right, (*above, (node.feature, node.threshold, False)))
    return out


def simplified(rule: tuple[Condition, ...]) -> tuple[Condition, ...]:
    """One bound on either side of a feature: the tightest."""
    tight: dict[tuple[int, bool], float] = {}
    for j, t, le in rule:
        k = (j, le)
        tight[k] = t if k not in tight else (min if le else max)(tight[k], t)
    return tuple(sorted((j, t, le) for (j, le), t in tight.items()))


def holds(rule: tuple[Condition, ...], x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for j, t, le in rule:
        out &= (x[:, j] <= t) == le
    return out


def fit_lasso_logistic(x: np.ndarray, y: np.ndarray, l1: float, steps: int = 400) -> tuple[np.ndarray, float]:
    """Weights and intercept (not penalised) by accelerated proximal gradient; columns of x within 0..1."""
    n, d = x.shape
    w, b = np.zeros(d), 0.0
    v, c, t = w.copy(), b, 1.0
    step = 4.0 / (np.linalg.norm(np.hstack([x, np.ones((n, 1))]), 2) ** 2 / n + 1e-9)
    for _ in range(steps):
        r = sigmoid(x @ v + c) - y
        nw = v - step * (x.T @ r) / n
        nw = np.sign(nw) * np.maximum(np.abs(nw) - step * l1, 0)
        nb = c - step * r.mean()
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, c = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = nw, nb, nt
    return w, float(b)
