"""A minimal perfect hash over 64-bit keys, built by levels.

At each level the remaining keys are hashed into a bit table; keys alone in their slot take its bit, the
others go on to the next level. A key's number is the count of set bits before its own over all
levels. The tables take about three bits a key, and a lookup touches one place per level.
"""

from __future__ import annotations

import numpy as np

from platterwatch.llm.texts import mix

SPACE = 1.5  # slots per key at a level


def level_hash(keys: np.ndarray, level: int) -> np.ndarray:
    salt = np.uint64((0x9E3779B97F4A7C15 * (2 * level + 1)) % (1 << 64))
    return mix(mix(keys.astype(np.uint64) + salt) * (salt | np.uint64(1)))


class PerfectHash:
    """Numbers 0 .. n - 1 for n distinct keys; any number or -1 for other keys."""

    def __init__(self, sizes: list[int], words: np.ndarray):
        self.sizes, self.words = sizes, words
        ones = np.bitwise_count(words).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(ones)])

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        keys, sizes, tables = keys.astype(np.uint64), [], []
        while len(keys):
            words = int(len(keys) * SPACE) // 64 + 1
            slot = (level_hash(keys, len(sizes)) % np.uint64(64 * words)).astype(np.int64)
            once = np.bincount(slot, minlength=64 * words) == 1
            tables.append(np.packbits(once, bitorder="little").view(np.uint64))
            sizes.append(words)
            keys = keys[~once[slot]]
        return cls(sizes, np.concatenate([np.zeros(0, np.uint64), *tables]))

    def find(self, keys: np.ndarray) -> np.ndarray:
        keys = keys.astype(np.uint64)
        out = np.full(len(keys), -1, np.int64)
        left, base = np.arange(len(keys)), 0
        for level, words in enumerate(self.sizes):
            slot = (level_hash(keys[left], level) % np.uint64(64 * words)).astype(np.int64)
            word, bit = base + slot // 64, (slot % 64).astype(np.uint64)
            table = self.words[word]
            hit = (table >> bit) & np.uint64(1) == 1
            below = table & ((np.uint64(1) << bit) - np.uint64(1))
            out[left[hit]] = (self.before[word] + np.bitwise_count(below))[hit]
            left, base = left[~hit], base + words
        return out

    @staticmethod
    def find_one(sizes: list[int], key: int, word_at) -> int:
        """The number of one key, -1 if no level has it. word_at(place) gives a table word and the ones before
        it, so a lookup touches one word a level."""
        one, base = np.array([key], np.int64).astype(np.uint64), 0
        for level, words in enumerate(sizes):
            slot = int(level_hash(one, level)[0] % np.uint64(64 * words))
            table, before = word_at(base + slot // 64)
            bit = slot % 64
            if table >> bit & 1:
                return before + (table & ((1 << bit) - 1)).bit_count()
            base += words
        return -1
