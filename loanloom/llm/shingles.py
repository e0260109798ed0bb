"""Word and shingle hashes of whole texts, on numpy arrays inside a task."""

from __future__ import annotations

import numpy as np
import xxhash

from loanloom.llm.caches import using

WORDS_KEPT = 200_000

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F,
                 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64)


class WordHashes(dict):
    """64-bit hash of a word; a bounded cache per worker."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > WORDS_KEPT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_known = WordHashes()


def using_words() -> None:
    """A task's start: keep the word hashes of this worker, drop other operators' caches."""
    using("words", _known.clear)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_known.__getitem__, words), dtype=np.uint64, count=len(words))


def finish(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words, in order."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        out = np.zeros(n, dtype=np.uint64)
        for i in range(size):
            # a rotation per round makes the sum depend on the order
            out = (out << np.uint64(7)) | (out >> np.uint64(57))
            out += hashes[i:i + n] * _ODD[i % len(_ODD)]
        return finish(out)


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct shingle hashes: words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lowered; fewer
    than ``size`` words, but some, are one shingle."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.empty(0, dtype=np.uint64)
    return np.unique(grams(word_hashes(words), min(size, len(words))))
