"""Words, shingles and their 64-bit hashes, for code that runs inside tasks.

A word is a maximal run of bytes other than ASCII blanks (``[^\\x20\\x09-\\x0D]+``).
``bytes.split()`` and ``bytes.lower()`` work on exactly these blanks and on A-Z
alone, so UTF-8 bytes are cut without a regular expression.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import xxhash

MAX_CACHED_WORDS = 250_000
_EMPTY = np.zeros(0, np.uint64)


class WordHashes(dict):
    """word -> 64-bit hash, computed once; emptied when it has grown too far."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, text: str | None) -> np.ndarray:
        """The hash of every word of the lower-cased text, in order."""
        if not text:
            return _EMPTY
        found = text.encode("utf-8").lower().split()
        if len(self) > MAX_CACHED_WORDS:
            self.clear()
        return np.fromiter(map(self.__getitem__, found), np.uint64, len(found))


@cache
def word_hashes() -> WordHashes:
    """One table per worker process, kept from task to task."""
    return WordHashes()


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers: multiply and shift, reversible."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """One hash for every ``width`` words in a row.

    A text with fewer words has one shingle, its whole sequence; one without
    words has none. The number of words goes into the hash.
    """
    n = len(words)
    if n == 0:
        return _EMPTY
    width = min(width, n)
    out = np.full(n - width + 1, width, np.uint64)
    for k in range(width):
        out = mix(out ^ words[k: n - width + 1 + k]) + np.uint64(k + 1)
    return out


def as_signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's BIGINT."""
    return x.view(np.int64)
