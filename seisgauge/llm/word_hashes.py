"""Hashes of words and of runs of words, vectorised inside tasks."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import xxhash

from .memory import until_the_task_ends

#: Words remembered by a task, and the longest of them: some 25 MB.
REMEMBERED, LONGEST = 200_000, 40

# Odd multipliers and shifts of a common 64-bit finalizer; any odd numbers would do.
_STEP = np.uint64(0x9E3779B97F4A7C15)
_FIRST = np.uint64(0xBF58476D1CE4E5B9)
_SECOND = np.uint64(0x94D049BB133111EB)


class _Hashes(dict):
    def __missing__(self, word: str | bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < REMEMBERED and len(word) <= LONGEST:
            self[word] = value
        return value


_known = until_the_task_ends(_Hashes())


def word_hashes(words: Sequence[str | bytes]) -> np.ndarray:
    """A 64-bit hash of each word."""
    return np.fromiter(map(_known.__getitem__, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection that spreads 64-bit values."""
    values = (values ^ (values >> np.uint64(30))) * _FIRST
    values = (values ^ (values >> np.uint64(27))) * _SECOND
    return values ^ (values >> np.uint64(31))


def run_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash of each run of ``length`` consecutive values; none if there are fewer."""
    n = hashes.size - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    held = np.full(n, length, np.uint64)
    for k in range(length):
        held = mixed(held * _STEP + hashes[k : k + n])
    return held
