"""Hashed word shingles of texts, with numpy."""

from __future__ import annotations

import numpy as np

WORDS = 5

#: Bytes of a lower-cased text that belong to words: letters, digits, all of other scripts.
_IN_WORD = np.zeros(256, bool)
_IN_WORD[list(b"abcdefghijklmnopqrstuvwxyz0123456789")] = True
_IN_WORD[128:] = True

_SEED = 11
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def powers(base: int, count: int) -> np.ndarray:
    """base ** 0 .. base ** (count - 1), by 64-bit arithmetic."""
    steps = np.full(count, base, np.uint64)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


def mix(values: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values evenly."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


class Shingler:
    """Texts to sorted arrays of the hashes of their different shingles."""

    def __init__(self, words: int = WORDS):
        self.words = words
        self.value = np.random.default_rng(_SEED).integers(1, 1 << 63, 256, dtype=np.uint64)
        self.up = self.down = None

    def __getstate__(self):
        return {**self.__dict__, "up": None, "down": None}

    def word_hashes(self, text: str) -> np.ndarray:
        data = np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8)
        if not len(data):
            return np.zeros(0, np.uint64)
        if self.up is None or len(self.up) < len(data):
            size = max(len(data), 1 << 17)
            self.up, self.down = powers(_BASE, size), powers(_INVERSE, size)
        inside = np.zeros(len(data) + 2, np.int8)
        inside[1:-1] = _IN_WORD[data]
        change = np.diff(inside)
        starts, ends = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.value[data] * self.up[: len(data)], out=total[1:])
        return mix((total[ends] - total[starts]) * self.down[starts] if len(starts) else total[:0])

    def shingles(self, text: str) -> np.ndarray:
        """Texts of fewer words than a shingle have one of all their words, or none."""
        words = self.word_hashes(text)
        if not len(words):
            return words
        width = min(self.words, len(words))
        total = np.zeros(len(words) - width + 1, np.uint64)
        for i in range(width):
            total = total * np.uint64(0x2545F4914F6CDD1D) + words[i : len(words) - width + 1 + i]
        return np.unique(mix(total + np.uint64(width)))
