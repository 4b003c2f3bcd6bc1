"""Difference covers: few places of each text that any two equal windows have in common.

A difference cover D of a period v holds, for any two places i and j, an offset
below v that takes both to places in D (modulo v).  So two equal windows of L
items share, at one offset below v, a sample of ``L - v + 1`` items that starts
at a cover place in both texts.
"""

from __future__ import annotations

import numpy as np

# Perfect difference sets: every difference modulo the period occurs (fixed values).
COVERS = {
    7: (0, 1, 3),
    13: (0, 1, 3, 9),
    21: (0, 1, 4, 14, 16),
    31: (0, 1, 3, 8, 12, 18),
    57: (0, 1, 3, 13, 32, 36, 43, 52),
}


def sample_size(window: int, period: int) -> int:
    if period not in COVERS or window < period:
        raise ValueError(f"no difference cover of period {period} within a window of {window}")
    return window - period + 1


def sample_places(offsets: np.ndarray, window: int, period: int) -> tuple[np.ndarray, np.ndarray]:
    """The cover places of each text at which a whole sample fits, ascending, and the number of each one's text."""
    size = sample_size(window, period)
    lengths = np.diff(offsets)
    longest = int(lengths.max(initial=0))
    rounds = np.arange(0, longest + 1, period)
    grid = (rounds[:, None] + np.array(COVERS[period])).ravel()
    each = np.where(lengths >= size, np.searchsorted(grid, lengths - size, side="right"), 0)
    text = np.repeat(np.arange(len(lengths)), each)
    first = np.cumsum(each) - each
    return grid[np.arange(len(text)) - first[text]] + offsets[:-1][text], text


def windows_around(places: np.ndarray, text: np.ndarray, offsets: np.ndarray, window: int, period: int) -> np.ndarray:
    """Starts of the whole windows that hold one of these samples at an offset below the period, ascending."""
    first = np.maximum(places - (period - 1), offsets[:-1][text])
    last = np.minimum(places, offsets[1:][text] - window)
    some = first <= last
    step = np.zeros(int(offsets[-1]) + 1, np.int64)
    np.add.at(step, first[some], 1)
    np.add.at(step, last[some] + 1, -1)
    return np.flatnonzero(np.cumsum(step[:-1]) > 0)
