"""An FM-index of a sequence of symbols: suffix order, wavelet matrix ranks, sampled positions."""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Order of all suffixes. 0 is a separator: each is unlike any other, earlier ones are smaller; the last symbol is one.

    Prefix doubling; only suffixes that are still tied are sorted again, so
    long repeats cost as much as there is of them.
    """
    n = len(symbols)
    separators = symbols == 0
    first = symbols.astype(np.int64) + int(separators.sum())
    first[separators] = np.arange(int(separators.sum()))
    order = np.argsort(first, kind="stable")
    rank = np.empty(n, np.int64)

    def settle(places: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Rank the suffixes that lie at these places of the order; returns the places still tied."""
        head = np.concatenate(([True], keys[1:] != keys[:-1]))
        rank[order[places]] = places[np.maximum.accumulate(np.where(head, np.arange(len(places)), 0))]
        alone = head & np.append(head[1:], True)
        return places[~alone]

    tied = settle(np.arange(n), first[order])
    step = 1
    while len(tied):
        at = order[tied]
        keys = rank[at] * n + rank[at + step]
        by = np.argsort(keys, kind="stable")
        order[tied] = at[by]
        tied = settle(tied, keys[by])
        step *= 2
    return order


class WaveletMatrix:
    """Access to and ranks of the symbols of a sequence, for arrays of questions."""

    def __init__(self, symbols: np.ndarray, alphabet: int):
        self.levels = max(1, int(alphabet - 1).bit_length())
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        for level in reversed(range(self.levels)):
            bit = (symbols >> level) & 1
            self.ones.append(np.concatenate(([0], np.cumsum(bit, dtype=np.int32))).astype(np.int32))
            self.zeros.append(int(len(symbols) - self.ones[-1][-1]))
            symbols = np.concatenate((symbols[bit == 0], symbols[bit == 1]))

    def rank(self, symbol: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        low, high = np.zeros_like(upto), upto
        for k, level in enumerate(reversed(range(self.levels))):
            one = ((symbol >> level) & 1).astype(bool)
            a, b = self.ones[k][low], self.ones[k][high]
            low = np.where(one, self.zeros[k] + a, low - a)
            high = np.where(one, self.zeros[k] + b, high - b)
        return high - low

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place, and how often it occurs before."""
        symbol, low, high = np.zeros_like(at), np.zeros_like(at), at
        for k in range(self.levels):
            a, b = self.ones[k][low], self.ones[k][high]
            one = self.ones[k][high + 1] > b
            symbol = symbol * 2 + one
            low = np.where(one, self.zeros[k] + a, low - a)
            high = np.where(one, self.zeros[k] + b, high - b)
        return symbol, high - low


class FMIndex:
    """Counts and finds phrases; phrases hold no separator (0)."""

    def __init__(self, symbols: np.ndarray, alphabet: int, every: int = 8):
        order = suffix_array(symbols)
        before = symbols[order - 1]  # the last symbol, a separator, comes before the first
        self.size = len(symbols)
        self.starts = np.concatenate(([0], np.cumsum(np.bincount(symbols, minlength=alphabet))))
        self.matrix = WaveletMatrix(before.astype(np.int64), alphabet)
        # Positions are kept for every eighth symbol and at the start of each run.
        self.sampled = (order % every == 0) | (before == 0)
        self.nth = np.cumsum(self.sampled) - 1
        self.positions = order[self.sampled]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) of the suffixes that begin with each phrase; phrases are rows, aligned to the right."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.size, np.int64)
        width = phrases.shape[1]
        for back in range(1, width + 1):
            live = np.flatnonzero((lengths >= back) & (high > low))
            if not len(live):
                break
            symbol = phrases[live, width - back]
            low[live] = self.starts[symbol] + self.matrix.rank(symbol, low[live])
            high[live] = self.starts[symbol] + self.matrix.rank(symbol, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Where the suffixes of these rows begin: steps back to a sampled one."""
        found = np.empty(len(rows), np.int64)
        todo, at, steps = np.arange(len(rows)), rows.copy(), 0
        while len(todo):
            there = self.sampled[at]
            found[todo[there]] = self.positions[self.nth[at[there]]] + steps
            todo, at = todo[~there], at[~there]
            symbol, before = self.matrix.access(at)
            at = self.starts[symbol] + before
            steps += 1
        return found
