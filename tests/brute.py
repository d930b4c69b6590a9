"""The measures computed person by person with NumPy, for small groups."""

from __future__ import annotations

import numpy as np
import pandas as pd


def ranked(y, w):
    y, w = np.asarray(y, float), np.asarray(w, float)
    keep = y >= 0
    y, w = y[keep], w[keep]
    order = np.lexsort((w, y))
    return y[order], w[order]


def _ratio(a, b):
    return None if b == 0 else a / b


def gini(y, w, method):
    y, w = ranked(y, w)
    c, cy = np.cumsum(w), np.cumsum(w * y)
    heads, total = c[-1], cy[-1]
    if method == "cumulative":
        if total == 0:
            return 0.0
        raw = 2 * np.sum(w * y * c) / (heads * total) - (heads + 1) / heads
        return min(max(raw, 0.0), 1.0)
    if method == "lorenz_left":
        return 0.0 if total == 0 else 1 - 2 * np.sum((cy - w * y) / total * w / heads)
    if method == "trapezoid":
        return None if total == 0 else 1 - 2 * np.sum(w * (cy - w * y / 2)) / (heads * total)
    if method == "pairs":
        gaps = np.abs(y[:, None] - y[None, :]) * w[:, None] * w[None, :]
        return _ratio(gaps.sum() / 2, heads * total)
    raise ValueError(method)


def palma(y, w, inclusive=False):
    y, w = ranked(y, w)
    c = np.cumsum(w)
    top = c >= 0.9 * c[-1] if inclusive else c > 0.9 * c[-1]
    low = c <= 0.4 * c[-1]
    return _ratio(np.sum((w * y)[top]), np.sum((w * y)[low]))


def bottom_mean(y, w):
    y, w = ranked(y, w)
    c = np.cumsum(w)
    low = c <= 0.4 * c[-1]
    return np.sum((w * y)[low]) / np.sum(w[low]) if np.sum(w[low]) > 0 else 0.0


def median(y, w):
    y, w = ranked(y, w)
    c = np.cumsum(w)
    return y[np.argmax(c >= 0.5 * c[-1])]


def poverty(y, w):
    half = median(y, w) / 2
    y, w = ranked(y, w)
    return np.sum(w[y < half]) / np.sum(w) if half else 0.0


def theil(y, w):
    y, w = ranked(y, w)
    y, w = y[y > 0], w[y > 0]
    if not len(y):
        return None
    r = y / np.average(y, weights=w)
    return np.average(r * np.log(r), weights=w)


def mld(y, w):
    y, w = ranked(y, w)
    y, w = y[y > 0], w[y > 0]
    if not len(y):
        return None
    return np.average(np.log(np.average(y, weights=w) / y), weights=w)


def quantile_shares(y, w, n):
    """(quantile, lowest, highest, mean, share) of each part that holds someone."""
    y, w = ranked(y, w)
    c, total = np.cumsum(w), np.sum(w * y)
    part = np.searchsorted(c[-1] * np.arange(1, n) / n, c) + 1
    people = pd.DataFrame({"part": part, "y": y, "w": w, "wy": w * y})[c > 0]
    parts = people.groupby("part").agg(
        low=("y", "min"), high=("y", "max"), w=("w", "sum"), wy=("wy", "sum")
    )
    parts["share"] = parts.wy / total if total > 0 else 0.0
    parts["mean"] = parts.wy / parts.w
    return list(parts[["low", "high", "mean", "share"]].itertuples(name=None))
