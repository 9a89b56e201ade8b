"""Hash helpers for code that runs in tasks on numpy arrays."""

from __future__ import annotations

import numpy as np


def mix(x: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finalizer; two seeds make two independent hashes."""
    with np.errstate(over="ignore"):
        x = x + np.uint64(seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))
