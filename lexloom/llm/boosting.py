"""Gradient-boosted trees with monotonic constraints, as flat numpy arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Nodes of all trees end to end; a leaf points to itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    bias: float

    def probability(self, x: np.ndarray) -> np.ndarray:
        """Chance of the positive class for each row of ``x``."""
        node = np.repeat(self.roots[None, :], len(x), 0)
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            goes_left = x[rows, self.feature[node]] <= self.threshold[node]
            node = np.where(goes_left, self.left[node], self.right[node])
        return 1 / (1 + np.exp(-(self.bias + self.value[node].sum(1))))


def fit(x: np.ndarray, y: np.ndarray, signs: np.ndarray, rounds: int = 40, depth: int = 3, rate: float = 0.25, bins: int = 64, least: int = 16, ridge: float = 1.0) -> Trees:
    """Boost trees under logistic loss.

    signs: for each feature +1 (the score may only rise with it), -1 (only
    fall) or 0.  A split whose children break its feature's sign is not made,
    and the middle of their values bounds whatever grows below them.
    """
    n, width = x.shape
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)] if n else [np.array([])] * width
    code = np.stack([np.searchsorted(edges[f], x[:, f], "left") for f in range(width)], 1) if n else np.zeros((0, width), int)
    mean = np.clip((y.sum() + 0.5) / (n + 1), 1e-3, 1 - 1e-3)
    bias = float(np.log(mean / (1 - mean)))
    margin = np.full(n, bias)
    feature, threshold, left, right, value, roots = [], [], [], [], [], []

    def add(v: float) -> int:
        at = len(feature)
        feature.append(0), threshold.append(0.0), left.append(at), right.append(at), value.append(v * rate)
        return at

    for _ in range(rounds if n else 0):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        best_value = lambda gs, hs, low, high: min(max(gs / (hs + ridge), low), high)
        root = add(best_value(g.sum(), h.sum(), -np.inf, np.inf))
        roots.append(root)
        work = [(root, np.arange(n), -np.inf, np.inf, 0)]
        while work:
            node, rows, low, high, level = work.pop()
            found = None
            if level < depth and len(rows) >= 2 * least:
                gs, hs = g[rows].sum(), h[rows].sum()
                for f in range(width):
                    if not len(edges[f]):
                        continue
                    c = code[rows, f]
                    size = len(edges[f]) + 1
                    cg = np.cumsum(np.bincount(c, g[rows], size))[:-1]
                    ch = np.cumsum(np.bincount(c, h[rows], size))[:-1]
                    cn = np.cumsum(np.bincount(c, minlength=size))[:-1]
                    a, b = np.clip(cg / (ch + ridge), low, high), np.clip((gs - cg) / (hs - ch + ridge), low, high)
                    gain = a * cg - a * a * (ch + ridge) / 2 + b * (gs - cg) - b * b * (hs - ch + ridge) / 2
                    ok = (cn >= least) & (len(rows) - cn >= least) & (signs[f] * (b - a) >= 0)
                    if ok.any():
                        k = int(np.argmax(np.where(ok, gain, -np.inf)))
                        if found is None or gain[k] > found[0]:
                            found = (gain[k], f, k, a[k], b[k])
                whole = best_value(gs, hs, low, high)
                if found and found[0] <= whole * gs - whole * whole * (hs + ridge) / 2 + 1e-6:
                    found = None
            if not found:
                margin[rows] += value[node]
                continue
            _, f, k, a, b = found
            goes = code[rows, f] <= k
            one, two = add(a), add(b)
            feature[node], threshold[node], left[node], right[node], value[node] = f, float(edges[f][k]), one, two, 0.0
            middle = (a + b) / 2
            for child, part, rising in ((one, rows[goes], signs[f] > 0), (two, rows[~goes], signs[f] < 0)):
                bounded = signs[f] != 0
                work.append((child, part, low if not bounded or rising else max(low, middle), min(high, middle) if bounded and rising else high, level + 1))
    return Trees(np.array(feature, np.int32), np.array(threshold), np.array(left, np.int32), np.array(right, np.int32), np.array(value), np.array(roots, np.int32), depth, bias)
