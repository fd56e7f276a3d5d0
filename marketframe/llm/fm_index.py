"""FM-index over integer sequences in numpy: suffix order, wavelet-matrix ranks, sampled positions."""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix order by prefix doubling.  Zeros end segments: each sorts below all symbols and, among
    themselves, by position, so no comparison goes past one and the rounds are the logarithm of a segment."""
    n = len(text)
    ends = text == 0
    rank = np.where(ends, np.cumsum(ends) - 1, text.astype(np.int64) + int(ends.sum()))
    k = 1
    while True:
        following = np.full(n, -1, np.int64)
        following[: n - k] = rank[k:]
        key = rank * (np.int64(max(rank.max(), n)) + 2) + following + 1
        order = np.argsort(key, kind="stable")
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        if rank[order[-1]] == n - 1 or k >= n:
            return order
        k *= 2


class WaveletMatrix:
    """Ranks of symbols in a sequence: one bit vector with running counts per level."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        self.levels = list(range(max(1, int(symbols).bit_length()) - 1, -1, -1))
        self.ones, self.zeros = [], []
        for level in self.levels:
            bit = (sequence >> level) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit)]).astype(np.int32))
            self.zeros.append(len(sequence) - int(self.ones[-1][-1]))
            sequence = np.concatenate([sequence[bit == 0], sequence[bit == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each position."""
        begin = np.zeros(len(at), np.int64)
        for level, ones, zeros in zip(self.levels, self.ones, self.zeros):
            bit = ((symbol >> level) & 1).astype(bool)
            at = np.where(bit, zeros + ones[at], at - ones[at])
            begin = np.where(bit, zeros + ones[begin], begin - ones[begin])
        return at - begin

    def access(self, at: np.ndarray) -> np.ndarray:
        symbol = np.zeros(len(at), np.int64)
        for level, ones, zeros in zip(self.levels, self.ones, self.zeros):
            bit = ones[at + 1] - ones[at]
            symbol |= bit.astype(np.int64) << level
            at = np.where(bit == 1, zeros + ones[at], at - ones[at])
        return symbol


class FMIndex:
    """Backward search and location over ``text``, whose zeros end segments.  Every ``sample``-th
    position of a segment, its first among them, keeps its place; others walk back to one."""

    def __init__(self, text: np.ndarray, sample: int = 8):
        self.text_length = len(text)
        order = suffix_array(text)
        symbols = int(text.max(initial=0))
        self.wavelet = WaveletMatrix(text[order - 1], symbols)       # of the first suffix: the last symbol, a zero
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols + 1))]).astype(np.int64)
        ends = np.flatnonzero(text == 0)
        first = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else np.zeros(1, np.int64)
        place = np.arange(len(text)) - first[np.searchsorted(ends, np.arange(len(text)), side="left")]
        sampled = (place % sample == 0)[order]
        self.sampled = np.concatenate([[0], np.cumsum(sampled)])
        self.positions = order[sampled]

    def count(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges [low, high) of patterns (a row each, symbols above 0), by backward search."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.text_length, np.int64)
        alive = np.arange(len(patterns))
        for column in range(patterns.shape[1] - 1, -1, -1):
            c = patterns[alive, column].astype(np.int64)
            known = c < len(self.before) - 1
            high[alive[~known]] = low[alive[~known]]
            alive, c = alive[known], c[known]
            low[alive], high[alive] = self.before[c] + self.wavelet.rank(c, low[alive]), self.before[c] + self.wavelet.rank(c, high[alive])
            alive = alive[low[alive] < high[alive]]
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix ranks."""
        out, walked = np.empty(len(rows), np.int64), 0
        left, at = np.arange(len(rows)), rows.astype(np.int64)
        while len(left):
            done = self.sampled[at + 1] > self.sampled[at]
            out[left[done]] = self.positions[self.sampled[at[done]]] + walked
            left, at = left[~done], at[~done]
            c = self.wavelet.access(at)
            at = self.before[c] + self.wavelet.rank(c, at)
            walked += 1
        return out
