"""Rolling hashes of many texts at once, as whole-array arithmetic.

A polynomial prefix hash modulo 2**64 over random byte values gives the hash of
any substring in constant time; the power of its position is divided out with
the inverse of the (odd) base, so equal substrings hash equally wherever they
stand.
"""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)          # odd, so it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def byte_values(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the entropy of 64-bit values over all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Roller:
    """Prefix hashes for buffers; the power tables grow to the largest one."""

    def __init__(self, seed: int = 1):
        self.values = byte_values(seed)
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) <= n:
            steps = np.full(max(n + 1, 1 << 16), _BASE)
            steps[0] = 1
            self.powers = np.cumprod(steps, dtype=np.uint64)
            steps[1:] = _INVERSE
            self.inverses = np.cumprod(steps, dtype=np.uint64)

    def prefix(self, data: np.ndarray) -> np.ndarray:
        """One longer than ``data`` (uint8, or uint64 values to hash as they are)."""
        self._grow(len(data))
        values = self.values[data] if data.dtype == np.uint8 else data
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(values * self.powers[:len(data)], out=out[1:], dtype=np.uint64)
        return out

    def grams(self, prefix: np.ndarray, size: int) -> np.ndarray:
        """Hash of every substring of ``size`` symbols."""
        n = len(prefix) - size
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((prefix[size:] - prefix[:n]) * self.inverses[:n])

    def spans(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((prefix[end] - prefix[start]) * self.inverses[start])


def join_bytes(parts: list[bytes], separator: bytes = b"\n") -> tuple[np.ndarray, np.ndarray]:
    """All parts in one buffer, each followed by the separator, and their starts
    (one more entry: the buffer's length)."""
    lengths = np.fromiter((len(p) + len(separator) for p in parts), np.int64, len(parts))
    starts = np.concatenate([[0], np.cumsum(lengths)])
    return np.frombuffer(separator.join([*parts, b""]), np.uint8), starts


def groups_of_size(lengths: list[int], most: int):
    """(first, last + 1) of runs of rows whose lengths add up to about ``most``."""
    start = size = 0
    for i, n in enumerate(lengths):
        if i > start and size + n > most:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(lengths):
        yield start, len(lengths)
