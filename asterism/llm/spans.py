"""Hashes of many spans of one byte string at once."""

from __future__ import annotations

import numpy as np

_rng = np.random.default_rng(20)
_BYTE = _rng.integers(0, 1 << 64, 256, np.uint64)
MULTIPLIERS = _rng.integers(0, 1 << 64, 8, np.uint64) | np.uint64(1)
_BASE = int(MULTIPLIERS[0])
# bytes for which the powers are kept
PIECE = 1 << 16


def _powers(base: int, n: int) -> np.ndarray:
    factors = np.full(n + 1, base, np.uint64)
    factors[0] = 1
    return factors.cumprod(dtype=np.uint64)


_POWER, _INVERSE = (_powers(b, PIECE) for b in (_BASE, pow(_BASE, -1, 1 << 64)))


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans of bytes: sums of the bytes' numbers times powers, as
    differences of running sums."""
    power, inverse = _POWER, _INVERSE
    if len(data) > PIECE:
        power, inverse = (_powers(b, len(data)) for b in (_BASE, pow(_BASE, -1, 1 << 64)))
    sums = np.concatenate([np.zeros(1, np.uint64), (_BYTE[data] * power[: len(data)]).cumsum(dtype=np.uint64)])
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
