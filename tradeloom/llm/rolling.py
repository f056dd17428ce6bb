"""Hashes of many substrings at once, from running sums over the bytes."""

from __future__ import annotations

import numpy as np

BASE = 0x5851F42D4C957F2D
INVERSE = pow(BASE, -1, 1 << 64)
CODES = np.random.default_rng(20).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray, turn: int = 0) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ x >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93 + 2 * turn)
    x = (x ^ x >> np.uint64(29)) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ x >> np.uint64(32)


class Powers:
    """Powers of the base and of its inverse, as many as were needed so far."""

    def __init__(self):
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) <= n:
            self.up, self.down = (
                np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n, base, np.uint64)]))
                for base in (BASE, INVERSE)
            )
        return self.up[: n + 1], self.down[: n + 1]


POWERS = Powers()


class Substrings:
    """A block of bytes whose substrings are hashed by start and end."""

    def __init__(self, data: np.ndarray):
        up, self.down = POWERS.to(len(data))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(CODES[data] * up[:-1], out=self.sums[1:])

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hashes; strings of different length differ too."""
        return mixed((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))
