"""Boosted regression trees for two classes, on binned features, and Platt calibration."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Trees:
    """Each tree is a complete tree of ``depth`` levels: feature and border of inner nodes, value of leaves."""

    feature: np.ndarray
    border: np.ndarray
    value: np.ndarray
    first: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.first)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, border, value in zip(self.feature, self.border, self.value, strict=True):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(int(np.log2(inner + 1))):
                node = 2 * node + 1 + (x[rows, feature[node]] > border[node])
            total += value[node - inner]
        return total


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 40, depth: int = 3, rate: float = 0.2, bins: int = 32, least: float = 1.0) -> Trees:
    """Newton boosting of the logistic loss; splits are searched among at most ``bins`` quantiles of a feature."""
    share = np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3)
    first = float(np.log(share / (1 - share)))
    borders = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) if len(x) else np.zeros(0) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(b, x[:, f], "left") for f, b in enumerate(borders)], axis=1)
    inner, margin = 2**depth - 1, np.full(len(x), first)
    features, cuts, values = [], [], []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = y - p, p * (1 - p)
        node = np.zeros(len(x), dtype=np.int64)
        feature, cut = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
        for k in range(inner):
            here = np.nonzero(node == k)[0]
            g, h, best = grad[here].sum(), hess[here].sum(), 1e-6
            split = None
            for f, b in enumerate(borders if len(here) > 1 else []):
                left_g = np.bincount(binned[here, f], grad[here], len(b) + 1).cumsum()[:-1]
                left_h = np.bincount(binned[here, f], hess[here], len(b) + 1).cumsum()[:-1]
                gain = left_g**2 / (left_h + least) + (g - left_g) ** 2 / (h - left_h + least) - g**2 / (h + least)
                if len(gain) and gain.max() > best:
                    best, split = float(gain.max()), (f, int(gain.argmax()))
            if split:
                feature[k], cut[k] = split[0], borders[split[0]][split[1]]
            node[here] = 2 * k + 1 + (x[here, feature[k]] > cut[k])
        leaf = node - inner
        value = rate * np.bincount(leaf, grad, inner + 1) / (np.bincount(leaf, hess, inner + 1) + least)
        margin += value[leaf]
        features.append(feature)
        cuts.append(cut)
        values.append(value)
    return Trees(np.array(features), np.array(cuts), np.array(values), first)


def calibrate(margin: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """(a, b) such that 1 / (1 + exp(-(a * margin + b))) is the probability; smoothed targets, Newton steps."""
    n1, n0 = y.sum(), len(y) - y.sum()
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(a * margin + b)))
        w = p * (1 - p) + 1e-9
        ga, gb = ((p - target) * margin).sum(), (p - target).sum()
        haa, hab, hbb = (w * margin**2).sum() + 1e-3, (w * margin).sum(), w.sum() + 1e-3
        det = haa * hbb - hab * hab
        a, b = a - (hbb * ga - hab * gb) / det, b - (haa * gb - hab * ga) / det
    return float(a), float(b)
