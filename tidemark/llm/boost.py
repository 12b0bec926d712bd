"""Boosting on binned features of a bounded training sample, in numpy, and isotonic calibration."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def quantile_edges(x: np.ndarray, bins: int) -> np.ndarray:
    """Cut points between bins; equal values always share a bin."""
    values = np.unique(x)
    if len(values) > bins:
        values = np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)))
    return (values[1:] + values[:-1]) / 2


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.column_stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)])


def log_odds(y: np.ndarray) -> float:
    """Of a smoothed base rate; 0 without rows."""
    return float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))


def _best_cut(g: np.ndarray, h: np.ndarray, lam: float) -> tuple[float, int]:
    """Gain and place of the best split of a row of bins."""
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gt, ht = g.sum(), h.sum()
    if not len(gl):
        return 0.0, 0
    gain = gl**2 / (hl + lam) + (gt - gl) ** 2 / (ht - hl + lam) - gt**2 / (ht + lam)
    k = int(np.argmax(gain))
    return float(gain[k]), k + 1


def shallow_tree(g: np.ndarray, h: np.ndarray, depth: int, lam: float) -> np.ndarray:
    """Values by bin of a tree of ``depth`` on one feature, from sums of gradients and hessians by bin."""
    out = np.full(len(g), -g.sum() / (h.sum() + lam))
    if depth:
        gain, k = _best_cut(g, h, lam)
        if gain > 1e-9:
            out[:k], out[k:] = shallow_tree(g[:k], h[:k], depth - 1, lam), shallow_tree(g[k:], h[k:], depth - 1, lam)
    return out


@dataclass
class AdditiveModel:
    """Lookup tables by feature and by pair of features; a score is the sum of the entries of a row's bins."""

    edges: list[np.ndarray]
    intercept: float
    tables: list[np.ndarray]
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        b = binned(x, self.edges)
        z = np.full(len(x), self.intercept)
        for j, t in enumerate(self.tables):
            z += t[b[:, j]]
        for (i, j), t in zip(self.pairs, self.pair_tables, strict=True):
            z += t[self.coarse[i][b[:, i]], self.coarse[j][b[:, j]]]
        return sigmoid(z)


def fit_additive(x: np.ndarray, y: np.ndarray, *, bins: int = 48, rounds: int = 60, rate: float = 0.15, depth: int = 2, n_pairs: int = 6, pair_bins: int = 8, pair_rounds: int = 30, lam: float = 2.0) -> AdditiveModel:
    """Cyclic boosting: in each round each feature in turn gets one shallow tree. Pairs are then chosen by the gain of a four-leaf tree on what the features leave, and boosted in the same way."""
    edges = [quantile_edges(x[:, j], bins) for j in range(x.shape[1])] if len(x) else [np.empty(0) for _ in range(x.shape[1])]
    tables = [np.zeros(len(e) + 1) for e in edges]
    model = AdditiveModel(edges, log_odds(y), tables)
    if len(np.unique(y)) < 2:
        return model
    b = binned(x, edges)
    z = np.full(len(y), model.intercept)
    for _ in range(rounds):
        for j, t in enumerate(tables):
            p = sigmoid(z)
            step = rate * shallow_tree(np.bincount(b[:, j], p - y, len(t)), np.bincount(b[:, j], p * (1 - p), len(t)), depth, lam)
            t += step
            z += step[b[:, j]]
    model.coarse = [(np.arange(len(t)) * pair_bins) // len(t) for t in tables]
    c = np.column_stack([m[b[:, j]] for j, m in enumerate(model.coarse)])

    def quadrants(i: int, j: int, p: np.ndarray) -> tuple[float, np.ndarray]:
        cell = c[:, i] * pair_bins + c[:, j]
        g = np.bincount(cell, p - y, pair_bins**2).reshape(pair_bins, -1)
        h = np.bincount(cell, p * (1 - p), pair_bins**2).reshape(pair_bins, -1)
        gc, hc = np.pad(g, ((1, 0), (1, 0))).cumsum(0).cumsum(1), np.pad(h, ((1, 0), (1, 0))).cumsum(0).cumsum(1)
        parts = []
        for s in (gc, hc):
            a = s[1:-1, 1:-1]
            parts.append((a, s[1:-1, -1:] - a, s[-1:, 1:-1] - a, s[-1, -1] - s[1:-1, -1:] - s[-1:, 1:-1] + a))
        gain = sum(u**2 / (v + lam) for u, v in zip(*parts, strict=True))
        k, m = np.unravel_index(int(np.argmax(gain)), gain.shape)
        leaf = [-(u[k, m] / (v[k, m] + lam)) for u, v in zip(*parts, strict=True)]
        out = np.empty((pair_bins, pair_bins))
        out[: k + 1, : m + 1], out[: k + 1, m + 1 :], out[k + 1 :, : m + 1], out[k + 1 :, m + 1 :] = leaf
        return float(gain[k, m]), out

    p = sigmoid(z)
    f = x.shape[1]
    gains = sorted(((quadrants(i, j, p)[0], i, j) for i in range(f) for j in range(i + 1, f)), reverse=True)
    model.pairs = [(i, j) for _, i, j in gains[:n_pairs]]
    model.pair_tables = [np.zeros((pair_bins, pair_bins)) for _ in model.pairs]
    for _ in range(pair_rounds):
        for (i, j), t in zip(model.pairs, model.pair_tables, strict=True):
            step = rate * quadrants(i, j, sigmoid(z))[1]
            t += step
            z += step[c[:, i], c[:, j]]
    return model


@dataclass
class TreeEnsemble:
    """Complete trees of one depth: at each level a feature and a bin for each node, then values by leaf."""

    edges: list[np.ndarray]
    intercept: float
    trees: list[tuple[list[np.ndarray], list[np.ndarray], np.ndarray]] = field(default_factory=list)

    def margin(self, x: np.ndarray) -> np.ndarray:
        b = binned(x, self.edges)
        rows, z = np.arange(len(x)), np.full(len(x), self.intercept)
        for features, cuts, leaves in self.trees:
            node = np.zeros(len(x), np.int64)
            for f, c in zip(features, cuts, strict=True):
                node = 2 * node + (b[rows, f[node]] >= c[node])
            z += leaves[node]
        return z


def fit_trees(x: np.ndarray, y: np.ndarray, *, bins: int = 32, rounds: int = 80, rate: float = 0.2, depth: int = 3, lam: float = 2.0) -> TreeEnsemble:
    """Gradient boosting with logistic loss; each node takes the split of largest gain over all features."""
    edges = [quantile_edges(x[:, j], bins) for j in range(x.shape[1])] if len(x) else [np.empty(0) for _ in range(x.shape[1])]
    model = TreeEnsemble(edges, log_odds(y))
    if len(np.unique(y)) < 2:
        return model
    b = binned(x, edges)
    width = [len(e) + 1 for e in edges]
    z = np.full(len(y), model.intercept)
    for _ in range(rounds):
        p = sigmoid(z)
        g, h, node = p - y, p * (1 - p), np.zeros(len(y), np.int64)
        features, cuts = [], []
        for level in range(depth):
            n = 2**level
            best, at, cut = np.zeros(n), np.zeros(n, np.int64), np.zeros(n, np.int64)
            for j, w in enumerate(width):
                cell = node * w + b[:, j]
                gs, hs = np.bincount(cell, g, n * w).reshape(n, w), np.bincount(cell, h, n * w).reshape(n, w)
                for k in range(n):
                    gain, c = _best_cut(gs[k], hs[k], lam)
                    if gain > best[k] + 1e-9:
                        best[k], at[k], cut[k] = gain, j, c
            features.append(at)
            cuts.append(cut)
            node = 2 * node + (b[np.arange(len(y)), at[node]] >= cut[node])
        leaves = -rate * np.bincount(node, g, 2**depth) / (np.bincount(node, h, 2**depth) + lam)
        model.trees.append((features, cuts, leaves))
        z += leaves[node]
    return model


def fit_isotonic(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: rising probabilities at rising margins, smoothed by one row of each label; read with ``np.interp``."""
    if not len(y):
        return np.array([-1.0, 1.0]), sigmoid(np.array([-1.0, 1.0]))
    order = np.argsort(margin, kind="stable")
    blocks: list[list[float]] = []  # positives, rows, sum of margins
    for m, v in zip(margin[order], y[order], strict=True):
        blocks.append([float(v), 1.0, float(m)])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            a = blocks.pop()
            blocks[-1] = [u + w for u, w in zip(blocks[-1], a, strict=True)]
    at = np.array([s / n for _, n, s in blocks])
    rate = np.array([(k + 0.5) / (n + 1) for k, n, _ in blocks])
    return at, np.maximum.accumulate(rate)
