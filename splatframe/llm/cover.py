"""Difference covers and fingerprints of byte ranges."""

from __future__ import annotations

import functools

import numpy as np

from splatframe.llm.common import splitmix

MASK = (1 << 64) - 1
BASE = 0x9E6C63D0A7F5B3C5 | 1
INVERSE = pow(BASE, -1, 1 << 64)
LETTERS = splitmix(np.arange(256, dtype=np.uint64) + np.uint64(77))


#: Fixed value: a perfect difference set.
PERFECT = {273: (1, 2, 4, 8, 16, 32, 64, 91, 117, 128, 137, 182, 195, 205, 234, 239, 256)}


@functools.cache
def difference_cover(modulus: int) -> np.ndarray:
    """A set of residues whose differences give every residue: greedily, the one that adds most differences next."""
    if modulus in PERFECT and len({(a - b) % modulus for a in PERFECT[modulus] for b in PERFECT[modulus]}) == modulus:
        return np.array(PERFECT[modulus])
    cover, have = [0], {0}
    while len(have) < modulus:
        best, gain = 0, -1
        for r in range(1, modulus):
            new = {(r - c) % modulus for c in cover} | {(c - r) % modulus for c in cover}
            if len(new - have) > gain:
                best, gain = r, len(new - have)
        have |= {(best - c) % modulus for c in cover} | {(c - best) % modulus for c in cover}
        cover.append(best)
    return np.array(sorted(cover))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    done = 1
    while done < n:  # doubling
        step = np.uint64(pow(base, done, 1 << 64))
        out[done : 2 * done] = out[: min(done, n - done)] * step
        done *= 2
    return out


class Fingerprints:
    """64-bit polynomial fingerprints of any range of data, each in constant time."""

    def __init__(self, data: np.ndarray) -> None:
        # powers are made anew: tables kept for each size stay in idle workers, next to those at work
        self.inverse = _powers(INVERSE, len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        terms = _powers(BASE, len(data))
        terms *= LETTERS[data]
        np.cumsum(terms, out=self.sums[1:])

    def of(self, starts: np.ndarray, length: int) -> np.ndarray:
        return splitmix((self.sums[starts + length] - self.sums[starts]) * self.inverse[starts] + np.uint64(length))
