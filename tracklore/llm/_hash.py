"""Vectorised 64-bit hashes of words, word windows and byte windows over a buffer of texts.

Prefix sums of a polynomial modulo 2**64 with an odd base give the hash of any span by one subtraction; every hash is
mixed before it is compared or cut into ranges. Two different values agree with odds of about 2**-64."""

from __future__ import annotations

import numpy as np

BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(BASE, -1, 2**64)
_up = np.ones(1, np.uint64)
_down = np.ones(1, np.uint64)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, *range(9, 14)]] = True


#: Most powers that a worker keeps, and bytes whose words are hashed at once.
KEPT, AT_ONCE = 1 << 22, 1 << 21


def _table(base: int, size: int) -> np.ndarray:
    steps = np.full(size, base, np.uint64)
    steps[0] = 1
    return np.cumprod(steps)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i < n; more than KEPT of them are made anew each time, so that one long text does not leave
    its tables behind."""
    global _up, _down
    if n > KEPT:
        return _table(BASE, n), _table(_INVERSE, n)
    if len(_up) < n:
        size = min(KEPT, max(2 * n, 1 << 16))
        _up, _down = _table(BASE, size), _table(_INVERSE, size)
    return _up[:n], _down[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def prefix(values: np.ndarray) -> np.ndarray:
    """Prefix sums for span(); values are uint64 and not zero."""
    up, _ = _powers(len(values))
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up, out=out[1:])
    return out


def span(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of values[start:end] for each pair."""
    _, down = _powers(len(sums))
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def windows(values: np.ndarray, width: int) -> np.ndarray:
    """Hash of each window of so many consecutive values."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    sums = prefix(values)
    _, down = _powers(len(sums))
    return mix((sums[width:] - sums[:n]) * down[:n] + np.uint64(width))


def byte_values(buffer: bytes) -> np.ndarray:
    return np.frombuffer(buffer, np.uint8).astype(np.uint64) + np.uint64(1)


class Words:
    """Words of several texts: byte ranges in the joined buffer, hashes, and the first word of each text."""

    def __init__(self, texts: list[bytes], lower: bool = False):
        self.buffer = b" ".join(texts)
        if lower:
            self.buffer = self.buffer.lower()  # bytes.lower changes A-Z alone
        data = np.frombuffer(self.buffer, np.uint8)
        space = IS_SPACE[data]
        edge = np.diff(np.concatenate(([True], space, [True])).astype(np.int8))
        self.start, self.end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        self.text_start = np.cumsum(sizes) - sizes
        self.first = np.append(np.searchsorted(self.start, self.text_start), len(self.start))
        self.count = np.diff(self.first)
        self.hash = self._hashes(data)

    def _hashes(self, data: np.ndarray) -> np.ndarray:
        """A word's hash does not depend on its place, so stretches of words are hashed one after the other."""
        out, i = np.empty(len(self.start), np.uint64), 0
        while i < len(out):
            first = int(self.start[i])
            j = max(i + 1, int(np.searchsorted(self.end, first + AT_ONCE, "right")))
            sums = prefix(data[first : int(self.end[j - 1])].astype(np.uint64) + np.uint64(1))
            out[i:j] = span(sums, self.start[i:j] - first, self.end[i:j] - first)
            i = j
        return out

    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.count)), self.count)
