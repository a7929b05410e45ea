"""Vectorised 64-bit hashing of byte ranges: prefix sums of a polynomial, and a mixer."""

from __future__ import annotations

from functools import cache

import numpy as np

U = np.uint64
BASE = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


@cache
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64."""
    inverse = pow(BASE, -1, 1 << 64)
    up, down = np.full(n, BASE, U), np.full(n, inverse, U)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def prefix_sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums that give the hash of bytes ``i`` to ``j`` as ``(sums[j] - sums[i]) * down[i]``; and ``down``."""
    up, down = powers(1 << int(len(data)).bit_length())
    sums = np.zeros(len(data) + 1, U)
    np.cumsum((data.astype(U) + U(1)) * up[: len(data)], out=sums[1:])
    return sums, down
