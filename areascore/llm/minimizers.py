"""Positions of window minima: equal windows choose the same place in them."""

from __future__ import annotations

import numpy as np


def leftmost_minima(values: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` values, where its smallest value is, the first of equal ones."""
    if len(values) < width:
        return np.zeros(0, np.int64)
    best, span = np.arange(len(values)), 1

    def closer(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return np.where(values[left] <= values[right], left, right)

    while span * 2 <= width:
        best = closer(best[:-span], best[span:])
        span *= 2
    rest = width - span
    return closer(best[: len(best) - rest], best[rest:]) if rest else best
