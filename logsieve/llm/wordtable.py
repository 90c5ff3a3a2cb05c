"""Word-level model values, worked out once per distinct word and worker."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

from .blocks import mix, text_bytes

#: Distinct words kept by a worker; beyond it the table starts anew with the next block.
MAX_WORDS = 1 << 18
_U = np.uint64
_SPREAD = np.random.default_rng(23).integers(1, 2**63, size=16, dtype=np.uint64) * _U(2) + _U(1)


class WordTable(dict):
    """word -> row of a table of `width` values, which `compute` gives for a list of new words."""

    def __init__(self, compute: Callable[[list[str]], np.ndarray], width: int):
        self.compute, self.width = compute, width
        self.reset()

    def reset(self):
        self.clear()
        self.new: list[str] = []
        self.done = 0
        self.table = np.zeros((1 << 12, self.width), np.float32)

    def __missing__(self, word):
        code = self[word] = len(self)
        self.new.append(word)
        return code

    def lookup(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Values of every word (white-space split) of the texts, and the texts' n + 1 offsets."""
        if len(self) > MAX_WORDS:
            self.reset()
        codes, off = [], np.zeros(len(texts) + 1, np.int64)
        for i, text in enumerate(texts):
            if text:
                codes += map(self.__getitem__, text.split())
            off[i + 1] = len(codes)
        if self.new:
            n = self.done + len(self.new)
            if n > len(self.table):
                self.table = np.concatenate([self.table, np.zeros((max(len(self.table), n), self.width), np.float32)])
            self.table[self.done : n] = self.compute(self.new)
            self.done, self.new = n, []
        return self.table[np.array(codes, np.int64)], off


def letters(word: str) -> str:
    """The word's letters alone, in lower case."""
    low = word.lower()
    return low if low.isalpha() else "".join(c for c in low if c.isalpha())


def byte_grams(words: list[str], sizes: tuple[int, ...], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed byte n-grams of `<word>` for each size, and n + 1 offsets; `buckets` is a power of two."""
    data, off = text_bytes(pa.array([f"<{w}>" for w in words], pa.string()))
    n, shift = len(data), _U(64 - (buckets.bit_length() - 1))
    out, row = [], []
    length = np.diff(off)
    owner = np.repeat(np.arange(len(words)), length)
    left = off[1:][owner] - np.arange(n)
    wide = data.astype(np.uint64) + _U(1)
    for size in sizes:
        at = np.flatnonzero(left >= size)
        acc = np.full(len(at), size, np.uint64)
        for j in range(size):
            acc += wide[at + j] * _SPREAD[j]
        out.append((mix(acc) >> shift).astype(np.int64))
        row.append(owner[at])
    out, row = np.concatenate(out), np.concatenate(row)
    order = np.argsort(row, kind="stable")
    ends = np.zeros(len(words) + 1, np.int64)
    np.cumsum(np.bincount(row, minlength=len(words)), out=ends[1:])
    return out[order], ends


def sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of consecutive stretches of rows; an empty stretch sums to 0."""
    total = np.zeros((len(values) + 1, *values.shape[1:]), np.float64)
    np.cumsum(values, axis=0, out=total[1:])
    return total[ends[1:]] - total[ends[:-1]]
