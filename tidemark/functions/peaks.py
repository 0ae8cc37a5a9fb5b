"""Peaks of one series: local maxima, then minimum spacing, then minimum prominence."""

from __future__ import annotations

import numpy as np


def local_maxima(x: np.ndarray) -> np.ndarray:
    """Positions higher than both neighbours; a flat top counts once, at its middle."""
    if len(x) < 3:
        return np.empty(0, dtype=int)
    first = np.concatenate([[0], np.flatnonzero(np.diff(x)) + 1])
    last = np.concatenate([first[1:] - 1, [len(x) - 1]])
    level = x[first]
    top = np.zeros(len(level), dtype=bool)
    top[1:-1] = (level[1:-1] > level[:-2]) & (level[1:-1] > level[2:])
    return (first[top] + last[top]) // 2


def spaced(peaks: np.ndarray, heights: np.ndarray, distance: int) -> np.ndarray:
    """Highest first, drop neighbours closer than ``distance``; of equal heights keep the later.

    Peaks still in question form a linked list, so each is met once when it falls: after the sort
    the work is linear.
    """
    n = len(peaks)
    at = peaks.tolist()
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    stays = [True] * n
    for j in np.argsort(heights, kind="stable")[::-1].tolist():
        if not stays[j]:
            continue
        i = before[j]
        while i >= 0 and at[j] - at[i] < distance:
            stays[i] = False
            i = before[i]
        before[j] = i
        if i >= 0:
            after[i] = j
        i = after[j]
        while i < n and at[i] - at[j] < distance:
            stays[i] = False
            i = after[i]
        after[j] = i
        if i < n:
            before[i] = j
    return peaks[np.array(stays, dtype=bool)]


def _lowest_since_higher(values: list[float]) -> list[float]:
    """For each value the lowest one after the last strictly higher value before it."""
    heights: list[float] = []  # falling: each is the last higher value for what follows it
    lows: list[float] = []
    out = []
    for h in values:
        low = h
        while heights and heights[-1] <= h:
            heights.pop()
            low = min(low, lows.pop())
        heights.append(h)
        lows.append(low)
        out.append(low)
    return out


def prominences(x: np.ndarray, peaks: np.ndarray) -> np.ndarray:
    """Height above the higher of the two lowest points before something higher, or the end.

    Only turning points and ends matter, and one pass in each direction over them serves all peaks.
    """
    if not len(peaks):
        return np.empty(0)
    first = np.concatenate([[0], np.flatnonzero(np.diff(x)) + 1])
    level = x[first]
    turns = np.ones(len(level), dtype=bool)
    turns[1:-1] = (level[1:-1] > level[:-2]) != (level[2:] > level[1:-1])
    first, values = first[turns], level[turns].tolist()
    left = np.array(_lowest_since_higher(values))
    right = np.array(_lowest_since_higher(values[::-1])[::-1])
    own = np.searchsorted(first, peaks, side="right") - 1
    return x[peaks] - np.maximum(left, right)[own]


def find_peaks(x: np.ndarray, distance: int, least: float) -> np.ndarray:
    peaks = local_maxima(x)
    peaks = spaced(peaks, x[peaks], distance)
    return peaks[prominences(x, peaks) >= least].astype(int)
