"""Bounded suffix order, wavelet tree and FM-index over small integer alphabets, in numpy.

The order compares ``depth`` symbols only. Backward search stays exact for
patterns of at most ``depth`` symbols, as extending a pattern by one symbol
needs the order of the shorter suffixes alone.
"""

from __future__ import annotations

import numpy as np

_ONE, _SIX = np.uint64(1), np.uint64(63)


def _dense(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by key, and each place's rank: how many keys are smaller (equal keys share it)."""
    order = np.argsort(key)
    ranked = key[order]
    new = np.ones(len(key), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    begin = np.flatnonzero(new)
    rank = np.empty(len(key), np.int64)
    rank[order] = np.repeat(begin, np.diff(np.r_[begin, len(key)]))
    return order, rank


def bounded_order(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order by the first ``depth`` symbols and ranks in it. Past the end comes before all symbols.

    As many symbols as fit one number are compared at first, then twice as many each round.
    """
    n = len(text)
    bits = max(1, int(text.max() + 1).bit_length()) if n else 1
    width = max(1, min(depth, 62 // bits))
    key = np.zeros(n, np.int64)
    for i in range(width):
        key <<= bits
        key[: max(0, n - i)] += text[i:] + 1
    order, rank = _dense(key)
    while width < depth:
        step = min(width, depth - width)
        key = rank * (n + 1)
        key[: max(0, n - step)] += rank[step:] + 1
        order, rank = _dense(key)
        width += step
    return order, rank


class BitVector:
    """Packed bits with a count before every 64."""

    def __init__(self, bits: np.ndarray) -> None:
        packed = np.packbits(bits, bitorder="little")
        words = np.zeros(len(bits) // 64 + 1, np.uint64)
        words.view(np.uint8)[: len(packed)] = packed
        self.words = words
        self.before = np.zeros(len(words), np.int32)
        np.cumsum(np.bitwise_count(words[:-1]), out=self.before[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = at >> 6
        mask = (_ONE << (at.astype(np.uint64) & _SIX)) - _ONE
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class WaveletTree:
    """Symbols 0 .. 2**levels - 1; one bit vector a level, most significant bit first, zeros sorted before ones."""

    def __init__(self, text: np.ndarray, levels: int) -> None:
        self.levels, self.bits, self.zeros = levels, [], []
        for level in range(levels - 1, -1, -1):
            bit = (text >> level) & 1
            self.bits.append(BitVector(bit.astype(bool)))
            self.zeros.append(int(len(text) - bit.sum()))
            text = np.concatenate([text[bit == 0], text[bit == 1]])
        # Where each symbol's copies begin in the last level.
        present, first = np.unique(text, return_index=True)
        self.leaf = np.zeros(int(present.max()) + 1 if len(present) else 1, np.int64)
        order = np.argsort(first)
        size = np.diff(np.r_[first[order], len(text)])
        self.leaf[present[order]] = np.cumsum(size) - size

    def rank(self, symbol: np.ndarray, at: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many copies of each symbol (of the text) lie before ``at`` and before ``end``."""
        for i, (bits, zeros) in enumerate(zip(self.bits, self.zeros)):
            one = ((symbol >> (self.levels - 1 - i)) & 1).astype(bool)
            a, b = bits.rank(at), bits.rank(end)
            at = np.where(one, zeros + a, at - a)
            end = np.where(one, zeros + b, end - b)
        return at - self.leaf[symbol], end - self.leaf[symbol]

    def split(self, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The distinct symbols of every range: index of the range, symbol, rank before the range, rank at its end."""
        which, symbol = np.arange(len(begin)), np.zeros(len(begin), np.int64)
        for bits, zeros in zip(self.bits, self.zeros):
            a, b = bits.rank(begin), bits.rank(end)
            left, right = np.flatnonzero(end - b > begin - a), np.flatnonzero(b > a)
            which = np.concatenate([which[left], which[right]])
            symbol = np.concatenate([symbol[left] * 2, symbol[right] * 2 + 1])
            begin, end = np.concatenate([(begin - a)[left], zeros + a[right]]), np.concatenate([(end - b)[left], zeros + b[right]])
        return which, symbol, begin - self.leaf[symbol], end - self.leaf[symbol]


class FmIndex:
    """Burrows-Wheeler transform of a text in a wavelet tree, with the bounded suffix order."""

    def __init__(self, text: np.ndarray, depth: int) -> None:
        self.depth, self.n = depth, len(text)
        self.order, self.suffix_rank = bounded_order(text, depth)
        symbols = int(text.max()) + 1 if len(text) else 1
        self.last = text[self.order - 1]
        self.bwt = WaveletTree(self.last, max(1, int(symbols - 1).bit_length()))
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])

    def runs(self, depth: int, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each place of the order, begin and end of the places whose suffixes share ``depth`` symbols with it."""
        rank = self.suffix_rank if depth == self.depth else bounded_order(text, depth)[1]
        ranked = rank[self.order]
        begin = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
        size = np.diff(np.r_[begin, self.n])
        return np.repeat(begin, size), np.repeat(begin + size, size)

    def extend(self, symbol: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward step: the ranges of symbol + pattern, from the patterns' ranges."""
        low, high = self.bwt.rank(symbol, begin, end)
        return self.first[symbol] + low, self.first[symbol] + high

    def steps(self) -> np.ndarray:
        """Backward step from each single place by the symbol before it."""
        step = np.empty(self.n, np.int64)
        step[np.argsort(self.last, kind="stable")] = np.arange(self.n)
        return step

    def boundaries(self, length: int) -> np.ndarray:
        """Where neighbours in the order share fewer than ``length`` symbols (place 0 and n included).

        Breadth first: the ranges of all strings of one length are extended backwards by every symbol
        before them. The end of a new range whose string has d + 1 symbols is a place where the common
        prefix is d, unless a shorter string ended there; only then is the range followed further.
        Common prefixes so appear by increasing value, and the walk stops before ``length``. A range
        of one place has one symbol before it, so its step needs no search.
        """
        marked = np.zeros(self.n + 1, bool)
        marked[[0, self.n]] = True
        step = self.steps()
        begin, end, single = np.array([0]), np.array([self.n]), np.zeros(0, np.int64)
        for _ in range(length):
            low_parts, high_parts = [], []
            for at in range(0, len(begin), 1 << 18):
                _, symbol, low, high = self.bwt.split(begin[at : at + (1 << 18)], end[at : at + (1 << 18)])
                low, high = self.first[symbol] + low, self.first[symbol] + high
                new = ~marked[high]
                low_parts.append(low[new])
                high_parts.append(high[new])
            single = step[single]
            single = single[~marked[single + 1]]
            begin, end = (np.concatenate(p) if p else np.zeros(0, np.int64) for p in (low_parts, high_parts))
            marked[end] = True
            marked[single + 1] = True
            alone = end - begin == 1
            single = np.concatenate([single, begin[alone]])
            begin, end = begin[~alone], end[~alone]
            if not len(begin) and not len(single):
                break
        return marked
