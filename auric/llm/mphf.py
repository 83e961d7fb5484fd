"""Minimal perfect hashing of 64-bit keys, built and looked up by arrays.

Level by level, each key left over marks one place of a bit array; the keys
that are alone at theirs stay there, the others go on to the next level. The
index of a key is the number of marked places before its own.
"""

from __future__ import annotations

import numpy as np

from auric.llm.wordhash import mix

_STEP = np.uint64(0x9E3779B97F4A7C15)


def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix(keys + _STEP * np.uint64(level + 1)) % np.uint64(size)).astype(np.int64)


class MinimalHash:
    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels                # 64-bit words of each bit array
        counts = [np.bitwise_count(words).astype(np.int64) for words in levels]
        self.before = []
        total = 0
        for c in counts:
            self.before.append(total + np.cumsum(c) - c)
            total += int(c.sum())
        self.size = total

    @classmethod
    def build(cls, keys: np.ndarray) -> "MinimalHash":
        """A hash of different keys onto 0 .. len(keys) - 1."""
        left, levels = keys.astype(np.uint64), []
        while len(left):
            size = 64 * (len(left) // 32 + 1)
            at = _places(left, len(levels), size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(np.packbits(alone, bitorder="little").view(np.uint64))
            left = left[~alone[at]]
        return cls(levels)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The index of each key. One that was not built in gets -1 or the index
        of another: compare it with the key stored there."""
        keys = keys.astype(np.uint64)
        found = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, (words, before) in enumerate(zip(self.levels, self.before)):
            at = _places(keys[left], level, 64 * len(words))
            word, bit = words[at >> 6], (at & 63).astype(np.uint64)
            here = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            found[left[here]] = (before[at >> 6] + below)[here]
            left = left[~here]
        return found

    def to_bytes(self) -> bytes:
        sizes = np.array([len(self.levels), *map(len, self.levels)], "<i8")
        return sizes.tobytes() + b"".join(words.astype("<u8").tobytes() for words in self.levels)

    @classmethod
    def from_bytes(cls, blob: bytes) -> "MinimalHash":
        n = int(np.frombuffer(blob, "<i8", 1)[0])
        sizes = np.frombuffer(blob, "<i8", n, 8)
        words = np.frombuffer(blob, "<u8", offset=8 + 8 * n)
        return cls(np.split(words, np.cumsum(sizes)[:-1]) if n else [])
