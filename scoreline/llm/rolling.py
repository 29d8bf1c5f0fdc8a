"""Hashes of all stretches of a byte array from one pass of prefix sums."""

from __future__ import annotations

import numpy as np

_WIDTH = 64
#: Powers by their base, in tables whose sizes are multiples of ``2 ** _ROUND``.
_TABLES: dict[int, np.ndarray] = {}
_ROUND = 18


def _constants(seed: int, entries: int) -> tuple[np.ndarray, int, int]:
    random = np.random.default_rng([20240601, seed])
    table = random.integers(0, 1 << 63, entries, dtype=np.int64).view(np.uint64) * np.uint64(2) + np.uint64(1)
    base = int(random.integers(1 << 40, 1 << 62)) * 8 + 5
    return table, base % (1 << _WIDTH), pow(base, -1, 1 << _WIDTH)


def _powers(base: int, size: int) -> np.ndarray:
    """Powers of ``base``, ``size`` of them at least; a worker keeps one table of each base."""
    made = _TABLES.get(base)
    if made is None or len(made) < size:
        made = np.full(-(-size >> _ROUND) << _ROUND, base, dtype=np.uint64)
        made[0] = 1
        np.multiply.accumulate(made, out=made)
        _TABLES[base] = made
    return made


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit over all (the polynomial alone leaves the low ones poor)."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    n = min(len(left), len(right))
    return mix(left[:n] * np.uint64(0x9E3779B97F4A7C15) + right[:n])


def stretches(values: np.ndarray, width: int) -> np.ndarray:
    """A hash of the ``width`` values from every place, made of hashes of 1, 2, 4, ... values that are mixed anew each time.

    Other than a polynomial modulo 2^64 it has no sequences that collide by their form.
    """
    n = max(len(values) - width + 1, 0)
    made, done, part, size = None, 0, values, 1
    while True:
        if width & size:
            made = part if made is None else _joined(made, part[done:])
            done += size
        if 2 * size > width:
            return made[:n]
        part = _joined(part, part[size:])
        size *= 2


class Rolling:
    """64-bit hashes of stretches of ``symbols`` (numbers below ``entries``); equal stretches hash alike."""

    def __init__(self, symbols: np.ndarray, seed: int = 0, entries: int = 256) -> None:
        table, base, inverse = _constants(seed, entries)
        size = max(1 << 20, len(symbols) + 1)
        self.undo = _powers(inverse, size)
        self.sums = np.zeros(len(symbols) + 1, np.uint64)
        np.cumsum(table[symbols] * _powers(base, size)[:len(symbols)], out=self.sums[1:])

    def between(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[begin]) * self.undo[begin])

    def windows(self, width: int) -> np.ndarray:
        """The hash of the stretch of ``width`` from every place."""
        n = len(self.sums) - width
        return mix((self.sums[width:] - self.sums[:n]) * self.undo[:n]) if n > 0 else np.zeros(0, np.uint64)
