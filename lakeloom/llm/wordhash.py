"""Hashes of all words of many texts at once, without a Python object per word."""

from __future__ import annotations

import numpy as np

BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)

#: True for ASCII letters and digits and for the bytes of all other characters.
IN_WORD = np.array([48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 or c >= 128 for c in range(256)])


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the low bits of 64-bit words over all bits."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9FB21C651E98DF25)
    return x ^ (x >> np.uint64(32))


class WordHasher:
    """Hash of each word: the sum of its bytes times powers of a base, modulo 2**64, then mixed.

    Words are runs of ASCII letters and digits and of all other characters beyond ASCII; only A-Z
    are lower-cased. The tables of powers grow to the longest slice seen.
    """

    def __init__(self):
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _grow(self, size: int) -> None:
        if len(self.powers) <= size:
            for name, factor in (("powers", BASE), ("inverses", INVERSE)):
                steps = np.full(size + 1, factor, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(hash, number of the text) of every word, in order."""
        data = np.frombuffer(b" ".join([*texts, b""]).lower(), np.uint8)
        self._grow(len(data))
        inside = np.zeros(len(data) + 2, np.int8)
        inside[1:-1] = IN_WORD[data]
        edges = np.flatnonzero(np.diff(inside))
        starts, ends = edges[::2], edges[1::2]
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.powers[: len(data)], out=sums[1:])
        words = mixed((sums[ends] - sums[starts]) * self.inverses[starts])
        first = np.cumsum([0, *(len(text) + 1 for text in texts)])
        return words, np.searchsorted(first, starts, side="right") - 1
