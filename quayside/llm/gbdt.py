"""Histogram gradient-boosted trees: fitted on a bounded sample, walked as flat arrays."""

from __future__ import annotations

import numpy as np


def fit(
    x: np.ndarray, y: np.ndarray, rounds: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64,
    weight: np.ndarray | None = None, ridge: float = 1.0, least: float = 3.0,
) -> dict[str, np.ndarray]:
    """Trees for log-odds of y (0/1). A tree is complete: inner node k has children 2k+1 and 2k+2;
    a node that isn't worth splitting sends every row left. Without rows or with one class the
    model is that class's smoothed share."""
    n, columns = x.shape
    inner, leaves = 2**depth - 1, 2**depth
    weight = np.ones(n) if weight is None else weight
    share = ((weight * y).sum() + 0.5) / (weight.sum() + 1)
    model = {
        "base": np.array(np.log(share / (1 - share))), "column": np.zeros((0, inner), np.int32),
        "above": np.zeros((0, inner), np.float32), "leaf": np.zeros((0, leaves)),
    }
    if n == 0 or y.min() == y.max():
        return model
    edges = [np.unique(np.quantile(x[:, c], np.linspace(0, 1, bins + 1)[1:-1])) for c in range(columns)]
    codes = np.stack([np.searchsorted(e, x[:, c], "left") for c, e in enumerate(edges)], 1).astype(np.int64)
    score = np.full(n, float(model["base"]))
    trees = []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-score))
        g, h = weight * (p - y), weight * p * (1 - p)
        column = np.zeros(inner, np.int32)
        above = np.full(inner, np.inf, np.float32)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            local = node - first
            best = np.full(width, 1e-6)
            cut = np.full(width, bins, np.int64)
            for c in range(columns):
                cell = local * bins + codes[:, c]
                gs = np.bincount(cell, g, width * bins).reshape(width, bins).cumsum(1)
                hs = np.bincount(cell, h, width * bins).reshape(width, bins).cumsum(1)
                ga, ha = gs[:, -1:], hs[:, -1:]
                gain = gs**2 / (hs + ridge) + (ga - gs)**2 / (ha - hs + ridge) - ga**2 / (ha + ridge)
                gain[(hs < least) | (ha - hs < least)] = 0
                at = gain.argmax(1)
                won = gain[np.arange(width), at] > best
                best[won] = gain[np.arange(width), at][won]
                cut[won] = at[won]
                column[first:first + width][won] = c
            for k in range(width):
                if cut[k] < bins and cut[k] < len(edges[column[first + k]]):
                    above[first + k] = edges[column[first + k]][cut[k]]
                else:
                    cut[k] = bins
            right = codes[np.arange(n), column[node]] > cut[local]
            node = 2 * node + 1 + right
        at = node - inner
        leaf = -rate * np.bincount(at, g, leaves) / (np.bincount(at, h, leaves) + ridge)
        score += leaf[at]
        trees.append((column, above, leaf))
    for k, name in enumerate(("column", "above", "leaf")):
        model[name] = np.stack([t[k] for t in trees])
    return model


def predict(model: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """Probabilities of class 1, all rows through one level of a tree at a time."""
    score = np.full(len(x), float(model["base"]))
    x = np.ascontiguousarray(x, np.float32)
    flat, width = x.ravel(), x.shape[1]
    start = np.arange(len(x)) * width
    for column, above, leaf in zip(model["column"], model["above"], model["leaf"]):
        node = np.zeros(len(x), np.int64)
        for _ in range(int(np.log2(len(leaf)))):
            node = 2 * node + 1 + (flat[start + column[node]] > above[node])
        score += leaf[node - len(column)]
    return 1 / (1 + np.exp(-score))
