"""Words and word hashes of whole texts in numpy, for use inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

_KEEP = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32
              for c in range(256))


def spaced_words(text: bytes | None) -> list[bytes]:
    """A-Z lowered, split at ASCII white space; null has none."""
    return text.lower().split() if text else []


def plain_words(text: bytes | None) -> list[bytes]:
    """A-Z lowered; runs of ASCII letters, digits and all characters beyond ASCII."""
    return text.translate(_KEEP).split() if text else []


class HashOfWord(dict):
    """Word to 64-bit hash, remembered up to a number of words, then started afresh."""

    def __init__(self, limit: int = 200_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_MUL = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_S32 = np.uint64(32)


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """64-bit hash of every run of ``k`` words; empty when there are fewer."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = words[:n].copy()
    for i in range(1, k):
        out *= _MUL
        out ^= out >> _S32
        out += words[i:i + n]
    for _ in range(2):
        out ^= out >> _S32
        out *= _MIX
    out ^= out >> _S32
    return out
