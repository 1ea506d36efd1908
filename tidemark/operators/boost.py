"""Gradient-boosted trees by the XGBoost paper (Chen and Guestrin, 2016), for many small datasets at once.

Each dataset has hundreds of rows; what is parallel is the experiments. So every
experiment is one group of ``applyInPandas``. For one large dataset use Spark's own
``GBTClassifier`` (see ``plans.learning.spark_model``).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np

# Parameters that hold unless overridden, fixed values.
BASE = {"n_estimators": 500, "learning_rate": 0.03, "max_depth": 3, "min_child_weight": 5.0, "gamma": 0.5, "subsample": 0.8, "colsample_bytree": 0.8, "reg_lambda": 5.0, "reg_alpha": 0.1}
# Values that random candidates are drawn from, fixed values.
GRID = {
    "n_estimators": [200, 400, 600, 800],
    "learning_rate": [0.01, 0.03, 0.05, 0.08],
    "max_depth": [2, 3, 4],
    "min_child_weight": [3, 5, 10, 15],
    "gamma": [0, 0.3, 0.5, 1.0, 2.0],
    "subsample": [0.7, 0.8, 0.9],
    "colsample_bytree": [0.7, 0.8, 0.9],
    "reg_lambda": [1.0, 5.0, 10.0, 20.0],
    "reg_alpha": [0.0, 0.1, 0.5, 1.0],
}
SEED = 42


def merged(overrides: dict | None = None) -> dict:
    p = BASE | {k: v for k, v in (overrides or {}).items() if v is not None and k in BASE}
    return p | {"n_estimators": int(p["n_estimators"]), "max_depth": int(p["max_depth"]), "min_child_weight": float(p["min_child_weight"])}


def candidates(count: int, seed: int = SEED) -> list[dict]:
    """The base parameters and ``count`` random ones."""
    rng = np.random.default_rng(seed)
    return [merged(), *(merged({k: v[rng.integers(len(v))] for k, v in GRID.items()}) for _ in range(count))]


def _shrunk(g: np.ndarray, alpha: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0)


@dataclass
class Booster:
    params: dict
    bins: int = 64

    def fit(self, x: np.ndarray, y: np.ndarray, positive_weight: float = 1.0) -> Booster:
        p, rng = self.params, np.random.default_rng(SEED)
        n, d = x.shape
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        q = np.stack([np.searchsorted(e, c, "right") for e, c in zip(self.edges, x.T)], 1) if d else np.zeros((n, 0), int)
        weight = np.where(y == 1, positive_weight, 1.0)
        margin, self.trees, self.gains = np.zeros(n), [], np.zeros(d)
        for _ in range(p["n_estimators"]):
            prob = 1 / (1 + np.exp(-margin))
            g, h = weight * (prob - y), weight * np.maximum(prob * (1 - prob), 1e-16)
            rows = np.flatnonzero(rng.random(n) < p["subsample"]) if p["subsample"] < 1 else np.arange(n)
            cols = np.sort(rng.choice(d, max(1, int(p["colsample_bytree"] * d)), False)) if d else np.zeros(0, int)
            tree = self._grow(q, g, h, rows, cols, p["max_depth"])
            self.trees.append(tree)
            margin += self._walk(tree, q)
        return self

    def _value(self, g: float, h: float) -> float:
        return float(-self.params["learning_rate"] * _shrunk(np.array(g), self.params["reg_alpha"]) / (h + self.params["reg_lambda"]))

    def _grow(self, q, g, h, rows, cols, depth):
        p = self.params
        gt, ht = g[rows].sum(), h[rows].sum()
        if depth == 0 or len(rows) < 2 or not len(cols):
            return self._value(gt, ht)
        width = self.bins + 1
        at = (q[rows][:, cols] + np.arange(len(cols)) * width).ravel()
        gs = np.bincount(at, np.repeat(g[rows], len(cols)), width * len(cols)).reshape(-1, width).cumsum(1)[:, :-1]
        hs = np.bincount(at, np.repeat(h[rows], len(cols)), width * len(cols)).reshape(-1, width).cumsum(1)[:, :-1]
        part = lambda a, b: _shrunk(a, p["reg_alpha"]) ** 2 / (b + p["reg_lambda"])
        gain = 0.5 * (part(gs, hs) + part(gt - gs, ht - hs) - part(gt, ht)) - p["gamma"]
        gain[(hs < p["min_child_weight"]) | (ht - hs < p["min_child_weight"])] = -math.inf
        f, b = divmod(int(gain.argmax()), width - 1)
        if not gain[f, b] > 0:
            return self._value(gt, ht)
        self.gains[cols[f]] += gain[f, b]
        left = q[rows, cols[f]] <= b
        return int(cols[f]), b, self._grow(q, g, h, rows[left], cols, depth - 1), self._grow(q, g, h, rows[~left], cols, depth - 1)

    def _walk(self, tree, q) -> np.ndarray:
        out = np.empty(len(q))
        stack = [(tree, np.arange(len(q)))]
        while stack:
            t, rows = stack.pop()
            if not isinstance(t, tuple):
                out[rows] = t
                continue
            f, b, left, right = t
            goes = q[rows, f] <= b
            stack += [(left, rows[goes]), (right, rows[~goes])]
        return out

    def predict(self, x: np.ndarray) -> np.ndarray:
        q = np.stack([np.searchsorted(e, c, "right") for e, c in zip(self.edges, x.T)], 1) if len(self.edges) else np.zeros((len(x), 0), int)
        m = np.zeros(len(x))
        for t in self.trees:
            m += self._walk(t, q)
        return 1 / (1 + np.exp(-m))

    def importance(self) -> np.ndarray:
        total = self.gains.sum()
        return self.gains / total if total else self.gains


def balanced_accuracy(y: np.ndarray, guess: np.ndarray) -> float:
    rates = [float((guess[y == k] == k).mean()) for k in (0, 1) if (y == k).any()]
    return sum(rates) / len(rates) if rates else 0.0


def tuned(x: np.ndarray, y: np.ndarray, positive_weight: float, count: int, days: np.ndarray | None = None, known: np.ndarray | None = None) -> dict:
    """The candidate of best balanced accuracy on the last fifth; labels not out by the split don't train."""
    if len(x) < 80 or len(np.unique(y)) < 2:
        return merged()
    at = int(len(x) * 0.8)
    use = np.ones(at, bool) if known is None or days is None else known[:at] <= days[:at].max()
    if len(np.unique(y[:at][use])) < 2:
        return merged()
    best, chosen = -1.0, merged()
    for p in candidates(count):
        s = balanced_accuracy(y[at:], (Booster(p).fit(x[:at][use], y[:at][use], positive_weight).predict(x[at:]) >= 0.5).astype(int))
        if s > best:
            best, chosen = s, p
    return chosen
