"""Gradient-boosted trees on binned features, for driver-side training on a bounded sample."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class BoostedTrees:
    """Binary classifier: complete trees of one depth over quantile bins, logistic loss, Platt-calibrated."""

    trees: int = 30
    depth: int = 4
    rate: float = 0.3
    bins: int = 32
    least: float = 2.0  # hessian a leaf needs to be split
    edges: list[np.ndarray] = field(default_factory=list)
    splits: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)  # feature, bin, leaf values
    base: float = 0.0
    scale: tuple[float, float] = (1.0, 0.0)

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], 1).astype(np.uint8)

    def fit(self, x: np.ndarray, y: np.ndarray, held: float = 0.2, seed: int = 5) -> BoostedTrees:
        """Fit on a part of the rows and calibrate on the rest, a share ``held`` of them."""
        y = np.asarray(y, float)
        self.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(x.shape[1])]
        b = self._binned(x)
        aside = np.random.default_rng(seed).random(len(y)) < held
        if len(y) < 50:
            aside[:] = False
        use = ~aside
        self.base = float(np.log((y[use].sum() + 0.5) / (len(y[use]) - y[use].sum() + 0.5)))
        margin = np.full(len(y), self.base)
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-margin))
            g, h = np.where(use, p - y, 0.0), np.where(use, p * (1 - p), 0.0)
            feature, cut, leaf = self._grow(b, g, h)
            self.splits.append((feature, cut, leaf))
            margin += leaf[self._leaf(b, feature, cut)]
        if aside.any() and 0 < y[aside].sum() < aside.sum():
            self.scale = platt(margin[aside], y[aside])
        return self

    def _grow(self, b: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n = 1 << self.depth
        feature, cut = np.zeros(n, int), np.full(n, 255)
        node = np.ones(len(b), int)
        width = self.bins + 1
        for level in range(self.depth):
            first = 1 << level
            at = node - first
            best = np.zeros(first)
            total_g, total_h = np.bincount(at, g, first), np.bincount(at, h, first)
            whole = total_g**2 / (total_h + 1)
            for j in range(b.shape[1]):
                hist_g = np.bincount(at * width + b[:, j], g, first * width).reshape(first, width).cumsum(1)[:, :-1]
                hist_h = np.bincount(at * width + b[:, j], h, first * width).reshape(first, width).cumsum(1)[:, :-1]
                rest_g, rest_h = total_g[:, None] - hist_g, total_h[:, None] - hist_h
                gain = hist_g**2 / (hist_h + 1) + rest_g**2 / (rest_h + 1) - whole[:, None]
                gain[(hist_h < self.least) | (rest_h < self.least)] = 0
                k = gain.argmax(1)
                v = gain[np.arange(first), k]
                better = v > best + 1e-9
                best[better], feature[first:2 * first][better], cut[first:2 * first][better] = v[better], j, k[better]
            node = 2 * node + (b[np.arange(len(b)), feature[node]] > cut[node])
        at = node - n
        leaf = -self.rate * np.bincount(at, g, n) / (np.bincount(at, h, n) + 1)
        return feature, cut, leaf

    def _leaf(self, b: np.ndarray, feature: np.ndarray, cut: np.ndarray) -> np.ndarray:
        node = np.ones(len(b), int)
        rows = np.arange(len(b))
        for _ in range(self.depth):
            node = 2 * node + (b[rows, feature[node]] > cut[node])
        return node - (1 << self.depth)

    def margin(self, x: np.ndarray) -> np.ndarray:
        if not len(x):
            return np.zeros(0)
        b = self._binned(x)
        margin = np.full(len(x), self.base)
        for feature, cut, leaf in self.splits:
            margin += leaf[self._leaf(b, feature, cut)]
        return margin

    def calibrated(self, margin: np.ndarray) -> np.ndarray:
        a, c = self.scale
        return 1 / (1 + np.exp(-np.clip(a * margin + c, -40, 40)))

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Calibrated probabilities."""
        return self.calibrated(self.margin(x))


def platt(margin: np.ndarray, y: np.ndarray, pull: float = 1.0) -> tuple[float, float]:
    """Slope and intercept by Newton steps that never raise the loss, with targets kept off 0 and 1 and a pull to (1, 0)."""
    hi, lo = (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2)
    t = np.where(y > 0.5, hi, lo)

    def loss(a: float, c: float) -> float:
        z = a * margin + c
        return float((np.logaddexp(0, z) - t * z).sum() + pull / 2 * ((a - 1) ** 2 + c**2))

    a, c = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + c, -40, 40)))
        g = np.array([((p - t) * margin).sum() + pull * (a - 1), (p - t).sum() + pull * c])
        w = p * (1 - p)
        hess = np.array([[(w * margin**2).sum() + pull, (w * margin).sum()], [(w * margin).sum(), w.sum() + pull]])
        step, size, now = np.linalg.solve(hess, g), 1.0, loss(a, c)
        while size > 1e-4 and loss(a - size * step[0], c - size * step[1]) > now:
            size /= 2
        a, c = a - size * step[0], c - size * step[1]
        if np.abs(size * step).max() < 1e-6:
            break
    return float(max(a, 0.05)), float(c)
