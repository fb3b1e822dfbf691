"""Word shingles of texts as sorted 64-bit hashes, for tasks that run Python."""

from __future__ import annotations

import numpy as np
import xxhash

_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))


class WordHashes(dict):
    """64-bit hashes of words; forgets all when ``most`` words are held."""

    def __init__(self, most: int = 300_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word, 42)
        return value


def lowered_words(text: str | None) -> list[bytes]:
    """Words between white space U+0009 to U+000D and U+0020, A to Z lower-cased, as UTF-8."""
    # On bytes, lower() and split() touch ASCII only.
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(33))) * _MIX[0]
    values = (values ^ (values >> np.uint64(33))) * _MIX[1]
    return values ^ (values >> np.uint64(33))


def shingle_set(words: list[bytes], hashes: WordHashes, width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the shingles; a shorter text is one shingle, none has none."""
    if not words:
        return np.empty(0, np.uint64)
    of_words = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    width = min(width, len(words))
    rows = len(words) - width + 1
    value = np.full(rows, np.uint64(width))
    for k in range(width):
        value = value * _STEP + of_words[k : k + rows]
    return np.unique(mixed(value))
