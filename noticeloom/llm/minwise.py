"""Minwise signatures with numpy: many hash functions over the hashed features of a row."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import xxhash

_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


@lru_cache(maxsize=16)
def family(size: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """``size`` multiply-add hash functions over 64 bits."""
    rng = np.random.default_rng(seed)
    return rng.integers(1, 2**63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 2**63, size, dtype=np.uint64)


@lru_cache(maxsize=500_000)
def hashed(feature: str) -> int:
    return xxhash.xxh3_64_intdigest(feature)


@lru_cache(maxsize=200_000)
def grams(word: str, n: int = 3) -> tuple[int, ...]:
    """Hashes of the letter n-grams of a word with its ends marked."""
    w = f"^{word}$"
    return tuple({hashed(w[i : i + n]) for i in range(max(1, len(w) - n + 1))})


def signature(features: np.ndarray, size: int, seed: int = 7) -> np.ndarray:
    """The minima of ``size`` hash functions over ``features`` (uint64); all ones if there is none."""
    if not len(features):
        return np.full(size, _EMPTY)
    a, b = family(size, seed)
    x = features[:, None] * a + b
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(16)).min(axis=0)


def bands(sig: np.ndarray, rows: int) -> list[int]:
    """One signed 64-bit key for each band of ``rows`` values."""
    raw = np.ascontiguousarray(sig)
    return [xxhash.xxh3_64_intdigest(raw[i : i + rows].tobytes(), seed=i) - 2**63 for i in range(0, len(raw) - rows + 1, rows)]
