"""A compressed FM-index over integer symbols, searched in numpy batches.

The Burrows-Wheeler transform of the text is kept as a wavelet matrix: one bit vector per bit
of the symbols, in 64-bit words with a running count per word, so ``rank`` is two look-ups and
a population count per level. Backward search extends all queries by one symbol at a time.
"""

from __future__ import annotations

import numpy as np


class _Bits:
    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        words = np.zeros(len(bits) // 64 + 1, dtype="<u8")
        words.view(np.uint8)[: len(packed)] = packed
        self.words = words
        self.before = np.zeros(len(words), dtype=np.int64)
        np.cumsum(np.bitwise_count(words[:-1]), out=self.before[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class FmIndex:
    """Index of ``text`` (symbols from 0; 0 separates). Suffixes are ordered by their first
    ``depth`` symbols, which is all that matches of up to ``depth`` symbols need."""

    def __init__(self, text: np.ndarray, depth: int):
        n = len(text)
        rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
        done = 1
        while True:
            after = np.full(n, -1, dtype=np.int64)
            after[: n - done] = rank[done:]
            key = rank * np.int64(n + 1) + (after + 1)
            order = np.argsort(key, kind="stable")
            step = np.empty(n, dtype=np.int64)
            step[0], sorted_key = 0, key[order]
            step[1:] = np.cumsum(sorted_key[1:] != sorted_key[:-1])
            rank = np.empty(n, dtype=np.int64)
            rank[order] = step
            done *= 2
            if done >= depth or step[-1] == n - 1:
                break
        self.order = order  # start of the i-th suffix
        bwt = text[order - 1]  # the symbol before it; the text is read as a circle
        symbols = int(text.max()) + 1
        self.first = np.zeros(symbols + 1, dtype=np.int64)
        np.cumsum(np.bincount(text, minlength=symbols), out=self.first[1:])
        self.levels: list[tuple[int, _Bits, int]] = []
        for bit in range(max(1, int(symbols - 1).bit_length()) - 1, -1, -1):
            ones = (bwt >> bit) & 1 == 1
            zeros = n - int(ones.sum())
            self.levels.append((bit, _Bits(ones), zeros))
            bwt = np.concatenate([bwt[~ones], bwt[ones]])

    def _rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol in the transform before each place."""
        start = np.zeros_like(at)
        for bit, bits, zeros in self.levels:
            one = (symbol >> bit) & 1 == 1
            both = bits.rank(np.concatenate([start, at]))
            r0, r1 = both[: len(at)], both[len(at) :]
            start = np.where(one, zeros + r0, start - r0)
            at = np.where(one, zeros + r1, at - r1)
        return at - start

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward step: the suffixes that start with ``symbol`` and go on as before."""
        r = self._rank(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        base = self.first[symbol]
        return base + r[: len(low)], base + r[len(low) :]

    def matching_statistics(self, text: np.ndarray, ends: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each end (exclusive) in ``text``: the length, up to ``limit``, of the longest run
        of symbols ending there that the index holds at least twice, and its suffix interval."""
        length = np.zeros(len(ends), dtype=np.int64)
        low, high = np.zeros(len(ends), dtype=np.int64), np.full(len(ends), len(self.order), dtype=np.int64)
        alive = np.arange(len(ends))
        for step in range(1, limit + 1):
            lo, hi = self.extend(text[ends[alive] - step], low[alive], high[alive])
            twice = hi - lo >= 2
            alive = alive[twice]
            low[alive], high[alive], length[alive] = lo[twice], hi[twice], step
            if not len(alive):
                break
        return length, low, high
