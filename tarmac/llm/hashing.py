"""Hashes of words and word n-grams inside tasks: numpy arrays of unsigned 64-bit numbers."""

import numpy as np
import xxhash

from tarmac.llm.common import worker_cache

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
CACHE_WORDS = 100_000


def word_hashes(words: list[bytes]) -> np.ndarray:
    known = worker_cache("word hashes", dict)
    found = list(map(known.get, words))
    i = -1
    for _ in range(found.count(None)):
        i = found.index(None, i + 1)
        found[i] = h = xxhash.xxh3_64_intdigest(words[i])
        if len(known) < CACHE_WORDS:
            known[words[i]] = h
    return np.array(found, np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over all (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ngrams(hashes: np.ndarray, k: int) -> np.ndarray:
    """One hash for each run of ``k`` words, in order; depends on ``k``."""
    n = len(hashes) - k + 1
    x = np.full(max(0, n), k, np.uint64)
    for i in range(k if n > 0 else 0):
        x = mixed(x * np.uint64(0x9E3779B97F4A7C15) + hashes[i:i + n])
    return x


def shingles(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct hashes of the ``k``-word shingles of the ASCII-lower-cased text; of all its words
    where there are fewer; none without words."""
    words = (text or "").encode().translate(LOWER).split()
    return np.unique(ngrams(word_hashes(words), min(k, len(words)))) if words else np.zeros(0, np.uint64)
