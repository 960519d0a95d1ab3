"""A compressed FM-index over word sequences: the Burrows-Wheeler transform in
a wavelet matrix of packed bits, searched backwards for many patterns at once."""

from __future__ import annotations

import numpy as np

WORD = np.uint64(64)


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling. Symbols are ranks from 0; each end
    mark must be a symbol of its own, so that no two suffixes are equal."""
    n = len(symbols)
    rank = symbols.astype(np.int64)
    k = 1
    while True:
        ahead = np.zeros(n, np.int64)
        ahead[: n - k] = rank[k:] + 1
        key = rank * (n + 2) + ahead
        order = np.argsort(key)
        run = key[order]
        new = np.empty(n, np.int64)
        new[order] = np.concatenate(([0], np.cumsum(run[1:] != run[:-1])))
        rank = new
        if k >= n or rank[order[-1]] == n - 1:
            return order
        k *= 2


class Bits:
    """Packed bits with counts of ones before each 64-bit word."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        padded = np.zeros((n // 64 + 1) * 64, np.uint8)
        padded[:n] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        ones = np.bitwise_count(self.words).astype(np.int32)
        self.before = np.concatenate(([0], np.cumsum(ones)[:-1])).astype(np.int32)
        self.zeros = n - int(ones.sum())

    def ones_below(self, at: np.ndarray) -> np.ndarray:
        block = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[block] + np.bitwise_count(self.words[block] & low)


class FMIndex:
    """Index over segments of word hashes, each closed by an end mark."""

    def __init__(self, segments: list[np.ndarray]):
        count = len(segments)
        lengths = np.array([len(s) for s in segments], np.int64)
        self.starts = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
        n = int(lengths.sum()) + count
        self.symbols = np.zeros(n, np.int64)  # 0 is the end mark
        is_word = np.ones(n, bool)
        is_word[self.starts + lengths] = False
        distinct, codes = np.unique(np.concatenate(segments), return_inverse=True)
        self.symbols[is_word] = codes + 1
        order = suffix_order(np.where(is_word, self.symbols + count - 1, np.cumsum(~is_word) - 1))
        transform = self.symbols[order - 1]  # the word before each suffix
        self.levels = max(1, len(distinct).bit_length())
        totals = np.bincount(self.symbols, minlength=len(distinct) + 1)
        self.first = np.concatenate(([0], np.cumsum(totals)))  # smallest suffix of each symbol
        self.bits: list[Bits] = []
        at = transform
        for level in range(self.levels - 1, -1, -1):
            bit = (at >> level) & 1
            self.bits.append(Bits(bit.astype(np.uint8)))
            at = np.concatenate((at[bit == 0], at[bit == 1]))
        # where each symbol's block starts at the bottom of the matrix
        self.bottom = np.zeros(len(distinct) + 1, np.int64)
        change = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        self.bottom[at[change]] = change

    def extend(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix intervals after putting a symbol before each pattern."""
        for level, bits in zip(range(self.levels - 1, -1, -1), self.bits):
            one = ((symbols >> level) & 1).astype(bool)
            ones_low, ones_high = bits.ones_below(low), bits.ones_below(high)
            low = np.where(one, bits.zeros + ones_low, low - ones_low)
            high = np.where(one, bits.zeros + ones_high, high - ones_high)
        shift = self.first[symbols] - self.bottom[symbols]
        return low + shift, high + shift

    def repeats(self, ends: np.ndarray, length: int) -> np.ndarray:
        """For each window of ``length`` words that ends before a place: how
        many of its words, read backwards, occur twice or more as a run;
        ``length`` if the whole window does."""
        out = np.full(len(ends), length, np.int64)
        lane = np.arange(len(ends))
        symbol = self.symbols[ends - 1]
        low, high = self.first[symbol], self.first[symbol + 1]
        for k in range(1, length + 1):
            alive = high - low >= 2
            if not alive.all():
                out[lane[~alive]] = k - 1
                lane, low, high = lane[alive], low[alive], high[alive]
            if k == length or not len(lane):
                break
            low, high = self.extend(self.symbols[ends[lane] - 1 - k], low, high)
        return out

    def covered(self, which: np.ndarray, windows: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """First and last window of each segment ``which`` that occurs twice
        or more, -1 if none does; ``windows`` is how many a segment has.

        Forwards, a window whose last m words occur once rules out all windows
        up to the one that starts behind their first word."""
        first = np.full(len(which), -1, np.int64)
        last = first.copy()
        base = self.starts[which]
        lane, at = np.arange(len(which)), np.zeros(len(which), np.int64)
        while len(lane):
            m = self.repeats(base[lane] + at + length, length)
            hit = m == length
            first[lane[hit]] = at[hit]
            at = at + length - m  # behind the first of the m + 1 words
            go = ~hit & (at < windows[lane])
            lane, at = lane[go], at[go]
        lane = np.flatnonzero(first >= 0)
        at = windows[lane] - 1
        while len(lane):
            done = at == first[lane]
            hit = done.copy()
            todo = np.flatnonzero(~done)
            hit[todo] = self.repeats(base[lane[todo]] + at[todo] + length, length) == length
            last[lane[hit]] = at[hit]
            lane, at = lane[~hit], at[~hit] - 1
        return first, last
