"""Words of whole texts as 64-bit numbers, many texts at a time."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import xxhash

from .tokenizer import Memo, blocks

#: Letters and digits; punctuation and underscores separate words.
PLAIN_WORD = re.compile(r"[^\W_]+")
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)]


def mixed(values: np.ndarray) -> np.ndarray:
    """Every input bit reaches every output bit (the finish of a 64-bit hash)."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def _hash(word: str) -> bytes:
    return xxhash.xxh64_digest(word.encode("utf-8", "replace"))


class WordHashes:
    """XXH64 of each word, and of its first letters for each length in `stems` (0 for words not longer).
    What was hashed lately is remembered within a bound."""

    def __init__(self, pattern: re.Pattern = PLAIN_WORD, lower: bool = True, stems: tuple[int, ...] = ()):
        self.find = pattern.findall
        self.lower = lower
        self.stems = stems
        self.memo = Memo(lambda words: [b"".join([_hash(w), *(_hash(w[:k]) if len(w) > k else bytes(8) for k in stems)]) for w in words])

    def of(self, values: list[str]) -> Iterator[tuple[int, list[list[str]], np.ndarray, np.ndarray]]:
        """For blocks of texts: index of the first, the words of each, a row of hashes for each word, and where each text begins."""
        for start, end in blocks(values):
            words = [self.find(t.lower() if self.lower else t) for t in values[start:end]]
            self.memo.learn(w for own in words for w in own)
            begins = np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))])
            known = self.memo.__getitem__
            raw = b"".join([b"".join(map(known, own)) for own in words])
            yield start, words, np.frombuffer(raw, ">u8").astype(np.uint64).reshape(-1, 1 + len(self.stems)), begins


def sequences(flat: np.ndarray, steps: tuple[int, ...], salt: int = 0) -> np.ndarray:
    """One number for the words at i + step, for every i from which all of them exist."""
    size = len(flat) - max(steps)
    if size <= 0:
        return np.empty(0, np.uint64)
    out = np.full(size, np.uint64(salt * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF), np.uint64)
    for k, step in enumerate(steps):
        out = out + (flat[step : step + size] ^ _ODD[k % 5]) * _ODD[(k + 2) % 5] * np.uint64(2 * k + 1)
        out = out ^ (out >> np.uint64(29))
    return out


def owners(begins: np.ndarray) -> np.ndarray:
    """The text that each word belongs to."""
    return np.repeat(np.arange(len(begins) - 1), np.diff(begins))
