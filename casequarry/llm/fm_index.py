"""FM-index over word numbers: wavelet-matrix ranks, backward search, sampled suffix positions."""

from __future__ import annotations

import numpy as np

SAMPLE_EVERY = 16


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; every separator (symbol 0) is a symbol of its own.

    Comparisons therefore end at the next separator, and the rounds grow with the logarithm of the
    longest run.
    """
    n = len(symbols)
    zeros = np.flatnonzero(symbols == 0)
    first = symbols.astype(np.int64) + len(zeros)
    first[zeros] = np.arange(len(zeros))
    order = np.argsort(first, kind="stable")
    rank = np.empty(n, np.int64)
    step = 1
    key = first
    while True:
        ordered = key[order]
        rank[order] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]]))
        if n == 0 or rank[order[-1]] == n - 1:
            return order
        after = np.zeros(n, np.int64)
        after[: n - step] = rank[step:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        step *= 2


class WaveletMatrix:
    """Rank of any symbol in any prefix, one bit level at a time, for many queries at once."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.bits = max(1, int(n_symbols - 1).bit_length())
        self.ones, self.zeros = [], []
        current = symbols
        for level in reversed(range(self.bits)):
            bit = (current >> level) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit)]).astype(np.int64))
            self.zeros.append(len(bit) - int(self.ones[-1][-1]))
            current = np.concatenate([current[bit == 0], current[bit == 1]])

    def start(self, symbol: np.ndarray) -> np.ndarray:
        """Where the block of a symbol begins after all levels."""
        low = np.zeros(len(symbol), np.int64)
        return self._descend(symbol, low)

    def _descend(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        for level, ones, zeros in zip(reversed(range(self.bits)), self.ones, self.zeros):
            before = ones[place]
            place = np.where((symbol >> level) & 1, zeros + before, place - before)
        return place

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        return self._descend(symbol, place) - self.start(symbol)


class FmIndex:
    """Index of runs of symbols ``1..n_symbols - 1``, each run followed by a separator 0."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        order = suffix_order(symbols)
        self.n = len(symbols)
        transformed = symbols[order - 1]
        self.wavelet = WaveletMatrix(transformed, n_symbols)
        self.transformed = transformed
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=n_symbols))])
        # Sampled are every few places and the starts of runs, so no walk passes a separator.
        sampled = (order % SAMPLE_EVERY == 0) | (transformed == 0)
        self.sampled = sampled
        self.sample_number = np.cumsum(sampled) - 1
        self.samples = order[sampled]

    def step(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        return self.smaller[symbol] + self.wavelet.rank(symbol, place)

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix-array interval of every phrase, read backwards from its last word.

        ``phrases`` is a matrix padded at the end; all phrases advance together.
        """
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.n, np.int64)
        for k in reversed(range(phrases.shape[1])):
            active = np.flatnonzero((k < lengths) & (low < high))
            symbol = phrases[active, k]
            low[active] = self.step(symbol, low[active])
            high[active] = self.step(symbol, high[active])
        return low, high

    def locate(self, places: np.ndarray) -> np.ndarray:
        """Text position of suffix-array places, walking left to the nearest sampled one."""
        places = places.copy()
        walked = np.zeros(len(places), np.int64)
        todo = np.flatnonzero(~self.sampled[places])
        while len(todo):
            here = places[todo]
            places[todo] = self.step(self.transformed[here], here)
            walked[todo] += 1
            todo = todo[~self.sampled[places[todo]]]
        return self.samples[self.sample_number[places]] + walked
