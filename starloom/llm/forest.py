"""Spanning stars of the links found inside one task."""

from __future__ import annotations

import numpy as np


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of ``n`` nodes the smallest node reachable over the links (a[i], b[i])."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while True:
            jump = new[new]
            if np.array_equal(jump, new):
                break
            new = jump
        open_ = new[a] != new[b]
        label, a, b = new, a[open_], b[open_]
    return label
