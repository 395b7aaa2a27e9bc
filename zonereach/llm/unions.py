"""Components of links that one task holds."""

from __future__ import annotations

import numpy as np


def stars(a: np.ndarray, b: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Smallest label of each node's component after the links a-b; a label names the root, and roots name themselves."""
    while True:
        one, two = label[a], label[b]
        on = one != two
        if not on.any():
            return label
        a, b, one, two = a[on], b[on], one[on], two[on]
        label = label.copy()
        np.minimum.at(label, np.maximum(one, two), np.minimum(one, two))
        while (label[label] != label).any():
            label = label[label]
