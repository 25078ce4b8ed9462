"""Hashes of 64-bit values in numpy."""

from __future__ import annotations

import numpy as np

PAIR = np.uint64(0x9E3779B97F4A7C15)
STEP = np.uint64(0xD6E8FEB86659FD93)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly."""
    x = (x ^ (x >> np.uint64(32))) * STEP
    x = (x ^ (x >> np.uint64(32))) * STEP
    return x ^ (x >> np.uint64(32))


def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of an ordered pair of hashes."""
    return mixed(a * PAIR + b)
