"""Words of a text as 64-bit hashes, and rolling hashes of their n-grams, with numpy."""

from __future__ import annotations

import re

import numpy as np
from xxhash import xxh3_64_intdigest

from feedwell.llm.chunks import ChunkTable, ragged

#: Letters and digits of any script; what lies between separates words.
WORD = re.compile(r"[^\W_]+")
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` words, by position: a Karp-Rabin polynomial modulo 2**64, mixed."""
    if len(words) < n:
        return np.empty(0, np.uint64)
    size = len(words) - n + 1
    value = words[:size].copy()
    for k in range(1, n):
        value *= _MULTIPLIER
        value += words[k : size + k]
    return mixed(value)


def mixed(value: np.ndarray) -> np.ndarray:
    """Spreads every bit over all others; maps different values to different ones."""
    value = value ^ (value >> np.uint64(31))
    value *= np.uint64(0xBF58476D1CE4E5B9)
    return value ^ (value >> np.uint64(29))


class FoldedWords:
    """Word hashes of a text, after case folding and without punctuation."""

    def __init__(self):
        self.table = ChunkTable(np.uint64)

    @staticmethod
    def _encode(chunks: list) -> tuple[np.ndarray, np.ndarray]:
        return ragged([[xxh3_64_intdigest(w) for w in WORD.findall(c.casefold())] for c in chunks], np.uint64)

    def of(self, text: str) -> np.ndarray:
        return self.table.rows(text.split(" "), self._encode)[0]

    def many(self, texts: list[str]) -> list[np.ndarray]:
        """The words of each text; fewer calls than one by one."""
        parts = [t.split(" ") for t in texts]
        values, sizes = self.table.rows([c for p in parts for c in p], self._encode)
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum([len(p) for p in parts])]
        return np.split(values, ends[:-1])


class PlainWords:
    """Word hashes of a text: A-Z in lower case, split at ASCII white space only."""

    def __init__(self):
        self.table = ChunkTable(np.uint64)

    @staticmethod
    def _encode(chunks: list) -> tuple[np.ndarray, np.ndarray]:
        return np.fromiter(map(xxh3_64_intdigest, chunks), np.uint64, len(chunks)), np.ones(len(chunks), np.int64)

    def many(self, texts: list[str]) -> list[np.ndarray]:
        parts = [t.encode("utf-8", "surrogatepass").lower().split() for t in texts]
        values, _ = self.table.rows([c for p in parts for c in p], self._encode)
        return np.split(values, np.cumsum([len(p) for p in parts])[:-1])
