"""A compressed FM-index of word sequences: packed wavelet matrix, backward search for many patterns at once."""

from __future__ import annotations

import numpy as np


class WaveletMatrix:
    """Symbols below ``2**levels`` in n * levels bits plus a count per 64 bits; rank queries on whole arrays."""

    def __init__(self, symbols: np.ndarray):
        self.n = len(symbols)
        self.levels = max(1, int(symbols.max(initial=0)).bit_length())
        self.words, self.counts, self.zeros = [], [], []
        now = symbols.astype(np.int64)
        for level in range(self.levels - 1, -1, -1):
            bits = (now >> level & 1).astype(bool)
            packed = np.packbits(bits, bitorder="little")
            words = np.zeros(self.n // 64 + 1, np.uint64)
            words.view(np.uint8)[:len(packed)] = packed
            self.words.append(words)
            self.counts.append(np.concatenate([[0], np.cumsum(np.bitwise_count(words))])[:-1].astype(np.int64))
            self.zeros.append(self.n - int(np.count_nonzero(bits)))
            now = np.concatenate([now[~bits], now[bits]])

    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.counts[level][word] + np.bitwise_count(self.words[level][word] & below)

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        low, high = np.zeros_like(at), at
        for level in range(self.levels):
            ones_low, ones_high = self._ones(level, low), self._ones(level, high)
            bit = symbol >> (self.levels - 1 - level) & 1 == 1
            low = np.where(bit, self.zeros[level] + ones_low, low - ones_low)
            high = np.where(bit, self.zeros[level] + ones_high, high - ones_high)
        return high - low


#: Length of the stretches whose suffix intervals are a by-product of sorting; a power of two.
SEED = 32


def suffix_array(text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of all suffixes by prefix doubling, and for the ``SEED`` symbols from each place the interval of suffixes that begin
    with them.  Separators (0) count as different symbols, earlier ones smaller."""
    n = len(text)
    stops = text == 0
    rank = np.where(stops, np.cumsum(stops) - 1, text + int(stops.sum()))
    step, seeds = 1, None
    while True:
        key = rank.astype(np.int64) * (int(rank.max(initial=0)) + 2)
        key[:max(0, n - step)] += rank[step:] + 1
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        new = np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]]) if n else np.empty(0, bool)
        place = np.cumsum(new) - 1
        rank = np.empty(n, np.int64)
        rank[order] = place
        step *= 2
        done = not n or place[-1] == n - 1
        if seeds is None and (step >= SEED or done):
            first = np.flatnonzero(new)
            seeds = first[rank], np.concatenate([first[1:], [n]])[rank]
        if done:
            return order, *seeds


class FMIndex:
    """Index of one shard's sequences of symbols from 1; ``owners`` has a number for each sequence."""

    def __init__(self, sequences: list[np.ndarray], owners: np.ndarray):
        sizes = np.array([len(s) for s in sequences], np.int64)
        self.starts = np.cumsum(sizes + 1) - sizes - 1
        self.text = np.zeros(int((sizes + 1).sum()), np.int64)
        for start, s in zip(self.starts.tolist(), sequences):
            self.text[start:start + len(s)] = s
        order, self.seed_low, self.seed_high = suffix_array(self.text)
        self.bwt = WaveletMatrix(self.text[order - 1])
        self.before = np.concatenate([[0], np.cumsum(np.bincount(self.text))])
        self.owners, self.owner = owners, np.repeat(owners, sizes + 1)[order]

    def intervals(self, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Suffix intervals of the ``length`` symbols before each place of the indexed text, by backward search
        from the seeds on.  Patterns that are down to one occurrence, their own, stop early with an empty interval."""
        low, high = np.zeros(len(ends), np.int64), np.zeros(len(ends), np.int64)
        seed = SEED if length >= SEED else 0
        if seed:  # the last symbols of each pattern have been looked up while sorting
            lo, hi = self.seed_low[ends - seed], self.seed_high[ends - seed]
            live = np.flatnonzero(hi - lo > 1)
            lo, hi = lo[live], hi[live]
        else:
            live, lo, hi = np.arange(len(ends)), np.zeros(len(ends), np.int64), np.full(len(ends), len(self.text), np.int64)
        for back in range(seed + 1, length + 1 if len(live) else 0):
            symbol = self.text[ends[live] - back]
            lo, hi = self.before[symbol] + self.bwt.rank(symbol, lo), self.before[symbol] + self.bwt.rank(symbol, hi)
            more = hi - lo > 1
            live, lo, hi = live[more], lo[more], hi[more]
            if not len(live):
                break
        low[live], high[live] = lo, hi
        return low, high

    def first_owners(self, length: int, chunk: int = 1 << 15) -> list[np.ndarray]:
        """For every window of ``length`` symbols of every sequence, the smallest owner of any sequence that has it."""
        sizes = np.diff(np.concatenate([self.starts, [len(self.text)]])) - 1
        windows = np.maximum(sizes - length + 1, 0)
        offset = np.arange(int(windows.sum())) - np.repeat(np.cumsum(windows) - windows, windows)
        ends = np.repeat(self.starts, windows) + offset + length
        result = np.repeat(self.owners, windows)
        for i in range(0, len(ends), chunk):
            low, high = self.intervals(ends[i:i + chunk], length)
            found = np.flatnonzero(high > low)
            if len(found):
                # intervals of equally long patterns are equal or disjoint
                starts, which = np.unique(low[found], return_inverse=True)
                stops = np.empty(len(starts), np.int64)
                stops[which] = high[found]
                edges = np.stack([starts, np.minimum(stops, len(self.text) - 1)], axis=1).ravel()
                least = np.minimum.reduceat(self.owner, edges)[::2]
                tail = stops == len(self.text)  # reduceat cannot name the end
                least[tail] = np.minimum(least[tail], self.owner[-1])
                result[i + found] = least[which]
        return np.split(result, np.cumsum(windows)[:-1])
