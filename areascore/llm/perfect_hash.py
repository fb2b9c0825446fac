"""Minimal perfect hash of one shard of 128-bit keys, with a fingerprint and a count per key.

A key is hashed into a bit array twice as long as the keys; keys that are alone on their bit keep it, the others
go to the next, smaller array. The number of set bits before a key's own is its place, so n keys have the
places 0 to n-1 and no key is stored: a fingerprint of 64 bits tells strangers apart.
"""

from __future__ import annotations

import numpy as np
from areascore.llm.words import mixed

#: Bits per key of each level's array.
GAMMA = 2
WORD = np.uint64(63)
SIX = np.uint64(6)
ODD = 0x9E3779B97F4A7C15


def _slots(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    salt = np.uint64((level + 1) * ODD & 0xFFFFFFFFFFFFFFFF)
    return mixed(mixed(keys ^ salt)) % np.uint64(size)


def build(keys: np.ndarray, prints: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes, bytes, bytes]:
    """Level sizes, bits, fingerprints and counts of distinct ``keys``, packed.

    Keys that are equal although their fingerprints differ (one in 2^64 pairs) cannot be parted by any level;
    a key is therefore mixed with its fingerprint first.
    """
    mine = mixed(keys ^ mixed(prints))
    levels, words, left = [], [], mine
    while len(left):
        size = max(64, -(-len(left) * GAMMA // 64) * 64)
        slots = _slots(left, len(levels), size)
        alone = np.bincount(slots.astype(np.int64), minlength=size) == 1
        levels.append(size)
        words.append(np.packbits(alone, bitorder="little").view("<u8"))
        left = left[~alone[slots.astype(np.int64)]]
        if len(levels) > 200:
            raise ValueError("keys of a shard are not distinct")
    sizes = np.array(levels, "<i8")
    bits = np.concatenate(words) if words else np.zeros(0, "<u8")
    shard = Shard(sizes.tobytes(), bits.tobytes(), b"", b"")
    places = shard.places(mine)
    order = np.empty(len(mine), np.int64)
    order[places] = np.arange(len(mine))
    return sizes.tobytes(), bits.tobytes(), prints[order].astype("<u8").tobytes(), counts[order].astype("<i8").tobytes()


class Shard:
    """The packed arrays of ``build``, opened for lookups."""

    def __init__(self, sizes: bytes, bits: bytes, prints: bytes, counts: bytes) -> None:
        self.sizes = np.frombuffer(sizes, "<i8")
        self.bits = np.frombuffer(bits, "<u8")
        self.prints, self.counts = np.frombuffer(prints, "<u8"), np.frombuffer(counts, "<i8")
        ones = np.bitwise_count(self.bits).astype(np.int64)
        self.before = np.cumsum(ones) - ones  # set bits before each word of 64

    def places(self, mine: np.ndarray) -> np.ndarray:
        """Place of each mixed key, -1 where every level says no."""
        found = np.full(len(mine), -1, np.int64)
        open_, base = np.arange(len(mine)), 0
        for level, size in enumerate(self.sizes):
            if not len(open_):
                break
            slot = _slots(mine[open_], level, int(size))
            word = self.bits[(slot >> SIX).astype(np.int64) + base]
            bit = np.uint64(1) << (slot & WORD)
            hit = (word & bit) != 0
            at = (slot[hit] >> SIX).astype(np.int64) + base
            found[open_[hit]] = self.before[at] + np.bitwise_count(word[hit] & (bit[hit] - np.uint64(1)))
            open_, base = open_[~hit], base + int(size) // 64
        return found

    def counts_of(self, keys: np.ndarray, prints: np.ndarray) -> np.ndarray:
        """Count of each key, 0 for keys that are not in the shard."""
        places = self.places(mixed(keys ^ mixed(prints)))
        known = places >= 0
        known[known] = self.prints[places[known]] == prints[known]
        out = np.zeros(len(keys), np.int64)
        out[known] = self.counts[places[known]]
        return out
