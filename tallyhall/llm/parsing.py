"""Prefix-free parsing of byte strings, in numpy.

Hashes of substrings come from one prefix sum: with an odd base, sums of
``letter * base**place`` modulo 2**64 differ by the substring, and the inverse
base shifts it to its start.
"""

from __future__ import annotations

import numpy as np

BASE = 0x9E3779B97F4A7C15 | 1
_LETTERS = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 2**64))):
            x = np.full(n, base, np.uint64)
            x[0] = 1
            _POWERS[name] = np.multiply.accumulate(x)
    return _POWERS["up"][:n], _POWERS["down"][:n]


class Hashes:
    """Hashes of all substrings of ``data`` (uint8)."""

    def __init__(self, data: np.ndarray):
        up, self.down = _powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_LETTERS[data] * up[:-1], out=self.sums[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        x = (self.sums[stop] - self.sums[start]) * self.down[start]
        x ^= x >> np.uint64(31)
        x *= np.uint64(0x7FB5D329728EA185)
        return x ^ (x >> np.uint64(29))


def sliding_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours."""
    n = len(x) - width + 1
    if n <= 0:
        return x[:0]
    span, low = 1, x
    while 2 * span <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    return np.minimum(low[:n], low[width - span:width - span + n])


class Parse:
    """A document cut by triggers, for windows of ``length`` bytes.

    The trigger of a window is the place, among the first ``reach`` ones, of
    the smallest rolling hash of ``gram`` bytes (the leftmost of equal ones):
    like a test of the hash modulo a number it looks at the window alone, so
    equal windows have equal triggers, but a trigger is never missing.  A
    phrase runs from a trigger past the next one, and lies within the window.

    For each phrase: ``first`` and ``last`` are the window starts whose
    trigger it begins with, ``phrase`` is its hash, and ``context`` is the
    hash of all bytes of those windows with the phrase's place in them."""

    def __init__(self, data: np.ndarray, length: int, gram: int = 16):
        reach = (length - gram) // 2
        n = len(data) - length + 1
        if n <= 0:
            self.first = self.last = np.zeros(0, np.int64)
            self.phrase = self.context = np.zeros(0, np.uint64)
            return
        self.hashes, self.length = Hashes(data), length
        at = np.arange(len(data) - gram + 1)
        low = sliding_minimum((self.hashes.of(at, at + gram) >> np.uint64(32) << np.uint64(32)) | at.astype(np.uint64), reach)
        trigger = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
        owner = trigger[:n]
        self.first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        self.last = np.concatenate([self.first[1:], [n]]) - 1
        start = owner[self.first]
        self.phrase = self.hashes.of(start, trigger[start + 1] + gram)
        self.context = self.hashes.of(self.first, self.last + length) + (start - self.first).astype(np.uint64)

    def windows(self, number: np.ndarray) -> np.ndarray:
        """Starts of all windows of the numbered phrases."""
        size = (self.last - self.first + 1)[number]
        return np.repeat(self.first[number] - np.cumsum(size) + size, size) + np.arange(size.sum())
