"""Counts of phrases of word ids in a trie whose leaves are hash containers.

The trie is shallow: its levels are four bits each, taken in turn from the ids of a phrase's first words, so that a word
which begins a third of all phrases is parted by what follows it. A leaf is an open-addressing table of
whole phrases; one that grows beyond ``burst`` phrases becomes an inner node with sixteen leaves. When the
trie holds more than ``budget`` phrases, the fullest subtrees of the root leave as sorted runs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from areascore.llm.words import ODD, mixed

FAN_BITS = 4
FAN = 1 << FAN_BITS
#: Words of a phrase that its path is made of, and bits taken of each.
PATH_WORDS, PATH_BITS = 3, 20
ROOT_LEVELS = 2


def hash_of(keys: np.ndarray) -> np.ndarray:
    """One hash per row of ids."""
    out = np.full(len(keys), ODD)
    for column in keys.T:
        out = mixed(out * ODD + column)
    return out


def paths(keys: np.ndarray) -> np.ndarray:
    """The path of each phrase, its first step in the highest bits."""
    words = min(PATH_WORDS, keys.shape[1])
    out = np.zeros(len(keys), np.uint64)
    for level in range(PATH_BITS // FAN_BITS * words):
        word, step = level % words, level // words
        shift = np.uint64(64 - FAN_BITS * (step + 1))
        out = out << np.uint64(FAN_BITS) | (keys[:, word] >> shift) & np.uint64(FAN - 1)
    return out << np.uint64(64 - PATH_BITS * words)


def prefix_of(path: np.ndarray, levels: int) -> np.ndarray:
    return path >> np.uint64(64 - FAN_BITS * levels)


class Container:
    """A hash table of phrases with their counts; a count of 0 is a free place."""

    def __init__(self, width: int, places: int = 1 << 10) -> None:
        self.width = width
        self._empty(places)

    def _empty(self, places: int) -> None:
        self.keys = np.zeros((places, self.width), np.uint64)
        self.counts = np.zeros(places, np.int64)
        self.claim = np.zeros(places, np.int64)
        self.size = 0

    def items(self) -> tuple[np.ndarray, np.ndarray]:
        there = np.flatnonzero(self.counts)
        return self.keys[there], self.counts[there]

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Add distinct phrases."""
        if 2 * (self.size + len(keys)) > len(self.counts):
            old = self.items()
            self._empty(1 << int(2 * (self.size + len(keys)) - 1).bit_length())
            self._put(*old)
        self._put(keys, counts)

    def _put(self, keys: np.ndarray, counts: np.ndarray) -> None:
        mask = np.uint64(len(self.counts) - 1)
        slot = (hash_of(keys) & mask).astype(np.int64)
        left = np.arange(len(keys))
        while len(left):
            at = slot[left]
            used = self.counts[at] > 0
            same = used & (self.keys[at] == keys[left]).all(axis=1)
            self.counts[at[same]] += counts[left[same]]
            free, place = left[~used], at[~used]
            self.claim[place] = free
            won = self.claim[place] == free
            self.keys[place[won]] = keys[free[won]]
            self.counts[place[won]] = counts[free[won]]
            self.size += int(np.count_nonzero(won))
            passed = left[used & ~same]
            slot[passed] = (slot[passed] + 1) & int(mask)
            left = np.concatenate([passed, free[~won]])


class HatTrie:
    def __init__(self, width: int, burst: int = 1 << 14, budget: int = 1 << 20) -> None:
        self.width, self.burst, self.budget = width, burst, budget
        self.root: dict[int, Container | dict] = {}
        self.sizes: dict[int, int] = {}

    def add(self, keys: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Count phrases, one a row; yields what is spilled: path, phrase and count of whole subtrees, sorted."""
        keys, counts = self._distinct(keys)
        if not len(keys):
            return
        path = paths(keys)
        order = np.argsort(path, kind="stable")
        keys, counts, path = keys[order], counts[order], path[order]
        for slot, part in self._parts(path, ROOT_LEVELS):
            node = self.root.get(slot)
            self.root[slot] = self._added(node or Container(self.width), keys[part], counts[part], path[part], ROOT_LEVELS)
            self.sizes[slot] = self._size(self.root[slot])
        if sum(self.sizes.values()) > self.budget:
            for slot in sorted(self.sizes, key=self.sizes.get, reverse=True):
                if sum(self.sizes.values()) * 2 <= self.budget:
                    break
                yield self._taken(slot)

    def rest(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for slot in sorted(self.root):
            yield self._taken(slot)

    @staticmethod
    def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return summed(keys, np.ones(len(keys), np.int64))

    @staticmethod
    def _parts(path: np.ndarray, levels: int) -> Iterator[tuple[int, slice]]:
        prefix = prefix_of(path, levels)
        first = np.flatnonzero(np.r_[True, prefix[1:] != prefix[:-1]])
        for start, stop in zip(first, np.r_[first[1:], len(path)]):
            yield int(prefix[start]), slice(start, stop)

    def _added(self, node: Container | dict, keys: np.ndarray, counts: np.ndarray, path: np.ndarray, level: int) -> Container | dict:
        if isinstance(node, Container):
            node.add(keys, counts)
            deepest = PATH_BITS // FAN_BITS * min(PATH_WORDS, self.width)
            if node.size <= self.burst or level >= deepest:
                return node
            keys, counts = node.items()
            path = paths(keys)
            order = np.argsort(path, kind="stable")
            keys, counts, path, node = keys[order], counts[order], path[order], {}
        for slot, part in self._parts(path, level + 1):
            child = node.get(slot) or Container(self.width)
            node[slot] = self._added(child, keys[part], counts[part], path[part], level + 1)
        return node

    def _size(self, node: Container | dict) -> int:
        return node.size if isinstance(node, Container) else sum(map(self._size, node.values()))

    def _leaves(self, node: Container | dict) -> Iterator[Container]:
        if isinstance(node, Container):
            yield node
        else:
            for slot in sorted(node):
                yield from self._leaves(node[slot])

    def _taken(self, slot: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        parts = [leaf.items() for leaf in self._leaves(self.root.pop(slot))]
        del self.sizes[slot]
        keys, counts = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        path = paths(keys)
        order = np.argsort(path, kind="stable")
        return path[order], keys[order], counts[order]


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of ids, ascending, and the sum of their counts."""
    order = np.lexsort(keys.T[::-1])
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)]) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts
