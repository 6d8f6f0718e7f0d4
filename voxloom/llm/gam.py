"""Generalised additive models with pairwise interactions, fitted by cyclic boosting of shallow trees.

A model is a table per feature and a table per chosen pair of features; a
score is the logistic of the sum of the looked-up bins.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

import numpy as np

#: Bins of a feature, bins of each side of a pair, rounds, step, leaves of a tree, pairs.
BINS, PAIR_BINS, ROUNDS, PAIR_ROUNDS, STEP, LEAVES, PAIRS = 48, 10, 150, 60, 0.1, 3, 6
RIDGE = 2.0


@dataclass
class Additive:
    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    pair_cuts: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)
    intercept: float = 0.0

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.intercept)
        for j, (c, t) in enumerate(zip(self.cuts, self.tables, strict=True)):
            out += t[np.searchsorted(c, x[:, j], side="right")]
        for (i, j), t in zip(self.pairs, self.pair_tables, strict=True):
            out += t[np.searchsorted(self.pair_cuts[i], x[:, i], side="right"), np.searchsorted(self.pair_cuts[j], x[:, j], side="right")]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def cut_points(v: np.ndarray, bins: int) -> np.ndarray:
    """At most bins - 1 values, from the quantiles of v, that split it."""
    q = np.unique(np.quantile(v, np.linspace(0, 1, bins + 1)[1:-1])) if len(v) else np.zeros(0)
    return q[q > v.min()] if len(v) else q


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Leaf value per bin of a tree with LEAVES leaves at most, each split the best of all leaves."""
    leaves = [(0, len(g))]
    while len(leaves) < LEAVES:
        best = (1e-9, None, None)
        for k, (a, b) in enumerate(leaves):
            if b - a < 2:
                continue
            gl, hl = np.cumsum(g[a : b - 1]), np.cumsum(h[a : b - 1])
            gt, ht = g[a:b].sum(), h[a:b].sum()
            gain = gl**2 / (hl + RIDGE) + (gt - gl) ** 2 / (ht - hl + RIDGE) - gt**2 / (ht + RIDGE)
            i = int(gain.argmax())
            if gain[i] > best[0]:
                best = (gain[i], k, a + i + 1)
        if best[1] is None:
            break
        a, b = leaves.pop(best[1])
        leaves += [(a, best[2]), (best[2], b)]
    out = np.zeros(len(g))
    for a, b in leaves:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + RIDGE)
    return out


def _corner(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values of the best four-cornered split of a pair's bins."""

    def quarters(x: np.ndarray) -> list[np.ndarray]:
        c = x.cumsum(0).cumsum(1)
        a, rows, cols, all_ = c[:-1, :-1], c[:-1, -1:], c[-1:, :-1], c[-1, -1]
        return [a, rows - a, cols - a, all_ - rows - cols + a]

    if min(g.shape) < 2:
        return 0.0, np.zeros_like(g)
    gs, hs = quarters(g), quarters(h)
    gain = sum(x**2 / (y + RIDGE) for x, y in zip(gs, hs, strict=True))
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    v = [x[i, j] / (y[i, j] + RIDGE) for x, y in zip(gs, hs, strict=True)]
    out = np.empty_like(g)
    out[: i + 1, : j + 1], out[: i + 1, j + 1 :], out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = v
    return float(gain[i, j] - g.sum() ** 2 / (h.sum() + RIDGE)), out


def fit(x: np.ndarray, y: np.ndarray) -> Additive:
    """Main tables by cyclic boosting, then the PAIRS pairs that gain most on what is left, boosted likewise."""
    n_features = x.shape[1]
    p0 = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
    m = Additive([cut_points(x[:, j], BINS) for j in range(n_features)], [], [cut_points(x[:, j], PAIR_BINS) for j in range(n_features)], intercept=float(np.log(p0 / (1 - p0))))
    at = [np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(m.cuts)]
    m.tables = [np.zeros(len(c) + 1) for c in m.cuts]
    margin = np.full(len(y), m.intercept)
    for _ in range(ROUNDS):
        for j in range(n_features):
            p = 1 / (1 + np.exp(-margin))
            size = len(m.tables[j])
            t = STEP * _tree(np.bincount(at[j], y - p, size), np.bincount(at[j], p * (1 - p), size))
            m.tables[j] += t
            margin += t[at[j]]
    coarse = [np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(m.pair_cuts)]
    shape = [len(c) + 1 for c in m.pair_cuts]

    def grids(i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-margin))
        cell, size = coarse[i] * shape[j] + coarse[j], shape[i] * shape[j]
        return np.bincount(cell, y - p, size).reshape(shape[i], shape[j]), np.bincount(cell, p * (1 - p), size).reshape(shape[i], shape[j])

    gains = sorted(((_corner(*grids(i, j))[0], (i, j)) for i, j in combinations(range(n_features), 2)), reverse=True)
    m.pairs = [p for gain, p in gains[:PAIRS] if gain > 0]
    m.pair_tables = [np.zeros((shape[i], shape[j])) for i, j in m.pairs]
    for _ in range(PAIR_ROUNDS):
        for k, (i, j) in enumerate(m.pairs):
            t = STEP * _corner(*grids(i, j))[1]
            m.pair_tables[k] += t
            margin += t[coarse[i], coarse[j]]
    return m
