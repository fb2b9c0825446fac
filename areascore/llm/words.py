"""Words and word shingles of many texts as arrays of 64-bit hashes."""

from __future__ import annotations

from itertools import chain

import numpy as np
import xxhash

KEPT_WORDS = 500_000
ODD = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xBF58476D1CE4E5B9)


class WordHashes(dict):
    """Hash of each word (bytes), computed once while it is kept."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > KEPT_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def flat(self, many: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words in a row, and where each text ends."""
        ends = np.cumsum(np.fromiter((len(w) for w in many), np.int64, len(many)))
        total = int(ends[-1]) if len(many) else 0
        hashes = np.fromiter(map(self.__getitem__, chain.from_iterable(many)), np.uint64, total)
        return hashes, ends


def mixed(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(30))
    values = values * MIX
    return values ^ (values >> np.uint64(29))


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each position on; the last ``size - 1`` positions are left out."""
    n = max(0, len(hashes) - size + 1)
    out = np.full(n, np.uint64(size))
    for k in range(size):
        out = mixed(out * ODD + hashes[k : k + n])
    return out


def split_words(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def shingle_sets(words: list[list[bytes]], size: int, hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, in a row; and where each text ends.

    A text of fewer than ``size`` words has its whole sequence as one shingle, an empty one has none.
    """
    flat, ends = hashes.flat(words)
    starts = ends - np.diff(ends, prepend=0)
    sizes = ends - starts
    whole = windows(flat, size)
    counts = np.maximum(sizes - size + 1, 0)
    owner = np.repeat(np.arange(len(words)), counts)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(starts, counts)
    values = whole[at]
    short = np.flatnonzero((sizes > 0) & (sizes < size))
    if len(short):
        extra = [windows(flat[starts[k] : ends[k]], int(sizes[k]))[0] for k in short]
        owner, values = np.r_[owner, short], np.r_[values, np.array(extra, np.uint64)]
    order = np.lexsort((values, owner))
    owner, values = owner[order], values[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    return values[new], np.cumsum(np.bincount(owner[new], minlength=len(words)))
