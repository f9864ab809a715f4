"""Seeded MinHash signatures and the sequential Bayesian pruning rule."""

from __future__ import annotations

from functools import lru_cache
from math import comb

import numpy as np


@lru_cache(maxsize=8)
def hash_family(size: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers (odd) and increments of ``size`` permutations of the 32-bit integers."""
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 1 << 32, size, dtype=np.uint32) | np.uint32(1)
    return a[:, None], rng.integers(0, 1 << 32, size, dtype=np.uint32)[:, None]


def signature(values: np.ndarray, size: int, seed: int) -> np.ndarray:
    """Minima of ``size`` permutations over a non-empty set of 64-bit hashes."""
    a, b = hash_family(size, seed)
    x = (values >> np.uint64(32)).astype(np.uint32)
    out = np.full(size, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 512):
        out = np.minimum(out, (a * x[None, i : i + 512] + b).min(axis=1))
    return out


@lru_cache(maxsize=32)
def least_matches(hashes: int, batch: int, threshold: float, miss: float) -> tuple[int, ...]:
    """For each prefix of ``batch``, ``2 * batch``, ... compared hashes, the fewest matches m
    a pair may show and stay in: with a uniform prior the posterior of the similarity s is
    Beta(m + 1, n - m + 1), and P(s >= t) = P(Binomial(n + 1, t) <= m); a pair leaves once
    this probability is below ``miss``."""
    out = []
    for n in range(batch, hashes + 1, batch):
        total, m = 0.0, 0
        while True:
            total += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if total >= miss:
                break
            m += 1
        out.append(m)
    return tuple(out)
