"""FM-index over the words of a shard's passages."""

from __future__ import annotations

import numpy as np


class WaveletTree:
    """Pointerless wavelet tree: one bit vector per level, counts per 64 bits."""

    def __init__(self, symbols: np.ndarray, alphabet: int):
        self.levels = max(1, int(alphabet - 1).bit_length())
        self.n = len(symbols)
        self.bits, self.counts, self.zeros = [], [], []
        for level in range(self.levels - 1, -1, -1):
            bit = ((symbols >> level) & 1).astype(bool)
            packed = np.packbits(bit, bitorder="little")
            words = np.zeros(len(packed) // 8 + 2, dtype=np.uint64)
            words.view(np.uint8)[: len(packed)] = packed
            self.bits.append(words)
            self.counts.append(np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)]))
            self.zeros.append(self.n - int(bit.sum()))
            symbols = np.concatenate([symbols[~bit], symbols[bit]])
        self.base = self._descend(np.arange(alphabet), np.zeros(alphabet, dtype=np.int64))

    def _descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for k in range(self.levels):
            word = at >> 6
            low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            ones = self.counts[k][word] + np.bitwise_count(self.bits[k][word] & low)
            at = np.where((symbol >> (self.levels - 1 - k)) & 1, self.zeros[k] + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        return self._descend(symbol, at) - self.base[symbol]


def sorted_suffixes(text: np.ndarray, separators: np.ndarray) -> np.ndarray:
    """Suffix array of texts of which each ends with 0; separators sort by their place."""
    n = len(text)
    rank = text.astype(np.int64) + len(separators)
    rank[separators] = np.arange(len(separators))
    step = 1
    order = np.argsort(rank, kind="stable")
    while True:
        key = rank[order]
        if step > 1 and len(key) and key[-1] == n - 1:
            return order
        pair = rank * (n + len(separators) + int(text.max(initial=0)) + 2)
        pair[: n - step] += rank[step:] + 1
        order = np.argsort(pair, kind="stable")
        key = pair[order]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
        step *= 2


class FmIndex:
    """Burrows-Wheeler transform of passages in a wavelet tree, searched backwards for many patterns at once."""

    def __init__(self, text: np.ndarray, separators: np.ndarray):
        alphabet = int(text.max(initial=0)) + 1
        order = sorted_suffixes(text, separators)
        self.tree = WaveletTree(text[order - 1], alphabet)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=alphabet))])

    def repeats(self, text: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Of the windows at `starts`, those that occur twice or more, and the interval of each.

        The interval of a window shrinks with every word put before it; a window whose interval holds one
        suffix occurs once and drops out: its matching statistic is below the threshold.
        """
        alive = np.arange(len(starts))
        symbol = text[starts + length - 1]
        low, high = self.first[symbol], self.first[symbol + 1]
        for k in range(length - 2, -1, -1):
            many = high - low > 1
            alive, low, high = alive[many], low[many], high[many]
            if not len(alive):
                break
            symbol = text[starts[alive] + k]
            base = self.first[symbol]
            low, high = base + self.tree.rank(symbol, low), base + self.tree.rank(symbol, high)
        many = high - low > 1
        return alive[many], low[many]
