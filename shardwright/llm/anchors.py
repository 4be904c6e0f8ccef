"""Content-defined anchors: a cheap, exact partition of all windows of a sequence.

Of the k-grams in a window the one with the least hash (the leftmost of
equals) is the window's anchor. It depends on the window's content alone, so
equal windows have equal anchors at equal places. Consecutive windows with one
anchor make a span; about 2 / (window - k + 2) spans begin at a position.
"""

from __future__ import annotations

import numpy as np

#: Odd multiplier of the polynomial hashes (fixed value).
BASE = 0x9E3779B97F4A7C15
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and its inverse modulo 2 ** 64 for i < n."""
    if len(_powers[0]) < n:
        size = max(n, 4096, 2 * len(_powers[0]))
        for at, base in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            _powers[at] = np.multiply.accumulate(factors)
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hashed:
    """Polynomial hashes of any range of a sequence of 64-bit symbols."""

    def __init__(self, symbols: np.ndarray):
        self.n = len(symbols)
        self.up, self.down = powers(self.n + 1)
        self.sums = np.zeros(self.n + 1, np.uint64)
        np.cumsum(symbols * self.up[:-1], out=self.sums[1:])

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])

    def grams(self, k: int) -> np.ndarray:
        """The hash of each k-gram."""
        return mix((self.sums[k:] - self.sums[:-k]) * self.down[:self.n - k + 1])


def least(values: np.ndarray, width: int) -> np.ndarray:
    """The place of the leftmost least value of each ``width`` consecutive ones."""
    at, have = np.arange(len(values)), 1
    while have < width:
        step = min(have, width - have)
        a, b = at[:-step], at[step:]
        at = np.where(values[b] < values[a], b, a)
        have += step
    return at


def spans(symbols: np.ndarray, k: int, window: int):
    """(key, first window, last window, hashes) of each span; None if no window fits."""
    if len(symbols) < window:
        return None
    hashed = Hashed(symbols)
    grams = hashed.grams(k)
    at = least(grams, window - k + 1)
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    last = np.append(first[1:], len(at)) - 1
    anchor = at[first]
    # The key also holds the anchor's place in the span's first window, so that equal content means equal windows.
    return grams[anchor], first, last, anchor, hashed
