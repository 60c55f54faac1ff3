"""A compressed index of a sequence of words, searched backwards.

The Burrows-Wheeler transform of the words is kept as a wavelet tree (its matrix form): one
vector of bits per bit of a word's number, with counts every 64 bits. A step of the search takes
an interval of suffixes to that of the suffixes with one word more in front, for many patterns
at a time.
"""

from __future__ import annotations

import numpy as np

_ONE = np.uint64(1)


class WaveletTree:
    """Counts of symbols (small integers) in prefixes of a sequence."""

    def __init__(self, symbols: np.ndarray, most: int):
        self.levels = range(max(1, int(most).bit_length()) - 1, -1, -1)
        self.bits, self.counts, self.zeros = [], [], []
        now = symbols
        for level in self.levels:
            bit = ((now >> level) & 1).astype(bool)
            packed = np.zeros(len(now) // 64 + 1, np.uint64)
            raw = np.packbits(bit, bitorder="little")
            packed.view(np.uint8)[: len(raw)] = raw
            ones = np.bitwise_count(packed).astype(np.int32)
            self.bits.append(packed)
            self.counts.append(np.cumsum(ones, dtype=np.int32) - ones)
            self.zeros.append(len(now) - int(bit.sum()))
            now = np.concatenate([now[~bit], now[bit]])
        every = np.arange(most + 1)
        self.first = self._follow(every, np.zeros(most + 1, np.int64))

    def _follow(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, bits, counts, zeros in zip(self.levels, self.bits, self.counts, self.zeros, strict=True):
            word = at >> 6
            below = bits[word] & ((_ONE << (at & 63).astype(np.uint64)) - _ONE)
            ones = counts[word] + np.bitwise_count(below)
            at = np.where((symbols >> level) & 1, zeros + ones, at - ones)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each of ``symbols`` stands before the place ``at`` beside it."""
        return self._follow(symbols, at) - self.first[symbols]


class FmIndex:
    """Index of ``text``, numbers of words from 1 on with a 0 after each piece.

    Strings of up to ``depth`` words can be told apart, so suffixes are sorted by so many words.
    """

    def __init__(self, text: np.ndarray, depth: int):
        self.text, self.depth = text, depth
        self.order, ranks = self._sorted()
        self.tree = WaveletTree(text[self.order - 1], int(text.max(initial=0)))
        count = np.bincount(text, minlength=int(text.max(initial=0)) + 1)
        self.smaller = np.cumsum(count) - count
        self.group = np.cumsum(self._fresh(ranks, depth)) - 1
        # Where the suffixes that share one word less with a given one begin and end.
        fresh = np.append(self._fresh(ranks, depth - 1), True)
        places = np.arange(len(text) + 1)
        self.low = np.maximum.accumulate(np.where(fresh, places, 0))
        self.high = np.minimum.accumulate(np.where(fresh, places, len(text))[::-1])[::-1]

    def _sorted(self) -> tuple[np.ndarray, list[np.ndarray]]:
        """The order of suffixes, and their ranks by their first 1, 2, 4, ... words, 0 beyond the end."""
        n = len(self.text)
        rank = np.zeros(n + 2 * self.depth, np.int64)
        rank[:n] = self.text + 1
        ranks, width = [rank], 1
        order = np.argsort(rank[:n], kind="stable")
        while width < self.depth:
            key = (rank[:n] << 32) | rank[width : n + width]
            order = np.argsort(key, kind="stable")
            own = key[order]
            rank = np.zeros(n + 2 * self.depth, np.int64)
            rank[order] = np.cumsum(np.append(True, own[1:] != own[:-1])[:n])
            ranks.append(rank)
            width *= 2
        return order, ranks

    def _fresh(self, ranks: list[np.ndarray], length: int) -> np.ndarray:
        """Whether each suffix differs from the one before it in the first ``length`` words."""
        out = np.ones(len(self.order), bool)
        if length < 1:
            out[1:] = False
            return out
        level = length.bit_length() - 1
        rank, rest = ranks[level], length - (1 << level)
        a, b = self.order[1:], self.order[:-1]
        out[1:] = (rank[a] != rank[b]) | (rank[a + rest] != rank[b + rest])
        return out

    def back(self, words: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals (from ``low`` up to ``high``) with one of ``words`` in front of each."""
        both = self.tree.rank(np.concatenate([words, words]), np.concatenate([low, high]))
        start = self.smaller[words]
        return start + both[: len(words)], start + both[len(words) :]

    def matches(self, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and interval's first suffix of every string of ``depth`` words in the pieces of
        ``text`` that begin at ``starts``.

        All pieces are read from their ends, one word each at a time. These are their matching
        statistics, cut at ``depth``: a match of that length is shortened by its last word before
        it is extended, so that the interval always is that of the longest match up to ``depth``.
        As the pieces themselves are in the index, no extension comes out empty.
        """
        by_size = np.argsort(-sizes, kind="stable")
        starts, sizes = starts[by_size], sizes[by_size]
        low, high = np.zeros(len(starts), np.int64), np.full(len(starts), len(self.text), np.int64)
        found, first = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for done in range(int(sizes.max(initial=0))):
            live = int(np.searchsorted(-sizes, -done, "left"))
            at = starts[:live] + sizes[:live] - 1 - done
            low, high = self.back(self.text[at], low[:live], high[:live])
            if done + 1 >= self.depth:
                found.append(at)
                first.append(low)
                low, high = self.low[low], self.high[high]
        return np.concatenate(found), np.concatenate(first)
