"""Word shingles of texts as 64-bit hashes, computed with numpy a batch of texts at a time."""

from __future__ import annotations

import numpy as np
import xxhash

from touchline.llm.workers import held

#: Words a worker remembers with their hashes (160 bytes or so each); beyond that it starts anew.
REMEMBERED = 200_000
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]  # the constants of splitmix64


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        number = xxhash.xxh64_intdigest(word)
        if len(word) <= 32:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = number
        return number



def mixed(x: np.ndarray) -> np.ndarray:
    """The finishing step of splitmix64, which makes every bit depend on every bit."""
    x = (x ^ (x >> np.uint64(30))) * _ODD[1]
    x = (x ^ (x >> np.uint64(27))) * _ODD[2]
    return x ^ (x >> np.uint64(31))


def words_of(text: str | None) -> list[bytes]:
    """Words between the white space of ASCII, A-Z in lower case: bytes know no other letters or spaces."""
    return (text or "").encode().lower().split()


def shingle_set(text: str | None, n: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles of ``n`` words; a shorter text is one shingle, one without words none."""
    words = words_of(text)
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(held("shingles", WordHashes).__getitem__, words), np.uint64, len(words))
    width = min(n, len(hashes))
    total = np.full(len(hashes) - width + 1, width, np.uint64)
    for i in range(width):
        total = mixed(total * _ODD[0] + hashes[i:len(hashes) - width + 1 + i])
    return np.unique(total)


def fingerprint(shingles: np.ndarray) -> int:
    """A signed 64-bit number of a set of shingles, equal for equal sets."""
    return int(np.int64(np.uint64(xxhash.xxh64_intdigest(shingles.tobytes()))))
