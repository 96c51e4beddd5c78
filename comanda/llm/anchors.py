"""Hashes of stretches of bytes, and the choice of the least in every window."""

from __future__ import annotations

import numpy as np

# Bytes hashed at once; a longer text is worked off in overlapping pieces.
PIECE = 1 << 18

_RANDOM = np.random.default_rng(20240611)
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEPS = [_RANDOM.integers(1, 1 << 63, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(32)]


def scramble(x: np.ndarray) -> np.ndarray:
    """Spread a 64-bit value over all its bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def doubled_hashes(data: np.ndarray, longest: int) -> list[np.ndarray]:
    """Hashes of the 1, 2, 4, ... bytes from each place on, up to ``longest``.

    The hash of a stretch is made from those of its halves, so equal stretches
    have equal hashes wherever they stand.
    """
    levels = [_BYTE[data]]
    width = 1
    while 2 * width <= min(longest, len(data)):
        last = levels[-1]
        both = last[:-width] * _STEPS[len(levels)] + last[width:]
        levels.append(both ^ (both >> np.uint64(32)))
        width *= 2
    return levels


def stretch_hash(levels: list[np.ndarray], starts: np.ndarray, length: int) -> np.ndarray:
    """Hashes of the stretches of ``length`` bytes at some places, from the levels."""
    found = np.full(len(starts), length, np.uint64)
    at = starts
    for i in range(len(levels) - 1, -1, -1):
        if length >> i & 1:
            found = scramble(found + levels[i][at])
            at = at + (1 << i)
    return found


def window_choices(values: np.ndarray, window: int) -> np.ndarray:
    """For each run of ``window`` values, the place of the least, the last of equal ones."""
    least, place = values, np.arange(len(values), dtype=np.int64)
    width = 1

    def widen(step: int) -> None:
        nonlocal least, place
        take = least[step:] <= least[:-step]
        place = np.where(take, place[step:], place[:-step])
        least = np.where(take, least[step:], least[:-step])

    while 2 * width <= window:
        widen(width)
        width *= 2
    if width < window:
        widen(window - width)
    return place
