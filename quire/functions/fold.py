"""Folds over ordered rows, for workers."""

from __future__ import annotations

import numpy as np


def block_map(lengths: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """For each length 0..most that a block may begin with: the length it ends with, and how many chunks it closes."""
    now, closed = np.arange(most + 1), np.zeros(most + 1, np.int64)
    for n in lengths.tolist():
        over = now + n > most
        closed += over & (now > 0)
        now = np.where(over, n, now + n)
    return now, closed
