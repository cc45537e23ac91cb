"""A compressed full-text index of word sequences: BWT in a wavelet tree of bit vectors."""

from __future__ import annotations

import numpy as np

_ONE = np.uint64(1)


class BitVector:
    """Bits in 64-bit words with a running count, for rank in constant time."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, np.uint64)
        self.words.view(np.uint8)[:len(packed)] = packed
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)[:-1]]).astype(np.int64)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        word = at >> 6
        low = (_ONE << (at & 63).astype(np.uint64)) - _ONE
        return self.before[word] + np.bitwise_count(self.words[word] & low)


class WaveletTree:
    """Rank of any symbol, one bit vector for each bit of the symbols, highest first."""

    def __init__(self, symbols: np.ndarray, size: int):
        self.levels = max(1, int(size - 1).bit_length())
        self.bits, self.zeros = [], []
        values = symbols
        for level in range(self.levels - 1, -1, -1):
            bit = (values >> level & 1).astype(bool)
            self.bits.append(BitVector(bit))
            self.zeros.append(int(len(bit) - bit.sum()))
            values = np.concatenate([values[~bit], values[bit]])

    def descend(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where the occurrences of each symbol before each position end in its leaf."""
        for k, level in enumerate(range(self.levels - 1, -1, -1)):
            ones = self.bits[k].rank(at)
            at = np.where(symbols >> level & 1, self.zeros[k] + ones, at - ones)
        return at


class FMIndex:
    """Index of segments of words, searched backwards for windows of a fixed length.

    ``words``: symbols of all segments, one after the other; ``lengths``: of each segment;
    ``owners``: a number for each segment. Ends of segments are symbols of their own that
    no window contains.
    """

    def __init__(self, words: np.ndarray, lengths: np.ndarray, owners: np.ndarray, window: int):
        self.window, count = window, len(lengths)
        self.symbols, codes = np.unique(words, return_inverse=True)
        segment = np.repeat(np.arange(count), lengths)
        text = np.zeros(len(words) + count, np.int64)
        place = np.arange(len(words)) + segment
        text[place] = codes + 1
        ends = np.cumsum(lengths) + np.arange(count)
        rank = np.where(text, text + count, 0)
        rank[ends] = np.arange(count) + 1
        order, step, prefix = np.argsort(rank, kind="stable"), 1, None
        rank = self._dense(rank, order)
        while True:
            if step <= window < 2 * step:
                prefix = (rank, step)
            if rank[order[-1]] == len(text) - 1 and prefix:
                break
            after = np.zeros(len(rank), np.int64)
            if step < len(rank):
                after[:-step] = rank[step:] + 1
            pair = rank * np.int64(len(rank) + 1) + after
            order = np.argsort(pair, kind="stable")
            rank, step = self._dense(pair, order), 2 * step
        self.size, self.alphabet = len(text), len(self.symbols) + 1
        self.tree = WaveletTree(text[order - 1], self.alphabet)
        first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=self.alphabet))[:-1]])
        every = np.arange(self.alphabet)
        self.shift = first - self.tree.descend(every, np.zeros(self.alphabet, np.int64))
        # Suffixes with the same first ``window`` symbols: their bounds and least owner.
        short, length = prefix
        later = np.minimum(order + window - length, len(text) - 1)
        new = np.ones(len(text), bool)
        new[1:] = (short[order][1:] != short[order][:-1]) | (short[later][1:] != short[later][:-1])
        starts = np.flatnonzero(new)
        self.group = np.cumsum(new) - 1
        self.bounds = np.append(starts, len(text))
        of = np.repeat(np.arange(count), lengths + 1)
        self.least = np.minimum.reduceat(owners[of[order]], starts)

    @staticmethod
    def _dense(values: np.ndarray, order: np.ndarray) -> np.ndarray:
        ordered = values[order]
        rank = np.empty(len(values), np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        return rank

    def least_owners(self, words: np.ndarray, lengths: np.ndarray):
        """Stream segments through the index, all at once from their last words on.

        Yields ``(segments, starts, owners)``: for windows that begin at ``starts``, the
        least owner of an indexed segment that holds the window. Each segment keeps the
        interval of suffixes that begin with its current window: one step of backward
        search prepends a word, and dropping the last word widens the interval to the
        bounds of its group. The streamed segments must be in the index, so that no step
        ends empty.
        """
        codes = np.searchsorted(self.symbols, words) + 1
        order = np.argsort(-lengths, kind="stable")
        last = np.cumsum(lengths)[order] - 1
        lengths = lengths[order]
        low, high = np.zeros(len(order), np.int64), np.full(len(order), self.size, np.int64)
        for step in range(int(lengths[0]) if len(lengths) else 0):
            n = int(np.searchsorted(-lengths, -step, side="left"))
            symbol = codes[last[:n] - step]
            low, high = (self.shift[symbol] + self.tree.descend(symbol, x[:n]) for x in (low, high))
            if step + 1 >= self.window:
                group = self.group[low]
                low, high = self.bounds[group], self.bounds[group + 1]
                yield order[:n], lengths[:n] - step - 1, self.least[group]
