"""A compressed FM-index over word sequences, with batched backward search."""

from __future__ import annotations

import numpy as np


class WaveletMatrix:
    """Rank over a sequence of small integers: a level of packed bits for each
    binary digit, with counts for each 64 of them."""

    def __init__(self, seq: np.ndarray, top: int):
        self.levels = max(1, int(top).bit_length())
        self.words, self.counts, self.zeros = [], [], []
        cur = seq.astype(np.int64)
        for level in range(self.levels - 1, -1, -1):
            bit = (cur >> level & 1).astype(np.uint8)
            packed = np.zeros((len(bit) // 64 + 1) * 8, np.uint8)
            raw = np.packbits(bit, bitorder="little")
            packed[:len(raw)] = raw
            words = packed.view(np.uint64)
            self.words.append(words)
            self.counts.append(np.r_[0, np.cumsum(np.bitwise_count(words), dtype=np.int64)][:-1].astype(np.int32))
            self.zeros.append(int(len(bit) - bit.sum()))
            cur = np.r_[cur[bit == 0], cur[bit == 1]]

    def _ones(self, level: int, i: np.ndarray) -> np.ndarray:
        at = i >> 6
        part = self.words[level][at] & ((np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1))
        return self.counts[level][at] + np.bitwise_count(part)

    def place(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Where the i first symbols of the sequence end among equal symbols,
        in the order of the last level; differences are ranks."""
        i = i.astype(np.int64)
        for level in range(self.levels):
            one = self._ones(level, i)
            up = (symbol >> (self.levels - 1 - level) & 1).astype(bool)
            i = np.where(up, self.zeros[level] + one, i - one)
        return i


class FMIndex:
    """Index of a text of integers from 1 on, parts ended by 0; each part has a
    rank (``owner``), and matches are held against the smallest rank that has them.

    ``depth`` bounds the length of matches: suffixes are sorted by as many symbols.
    """

    def __init__(self, text: np.ndarray, owner: np.ndarray, depth: int):
        self.n = n = len(text)
        ranks = [np.unique(text, return_inverse=True)[1].astype(np.int64)]
        size, order = 1, None
        while size < depth:
            ahead = np.zeros(n, np.int64)
            ahead[:n - size] = ranks[-1][size:] + 1
            key = ranks[-1] * (n + 1) + ahead
            order = np.argsort(key, kind="stable")
            key = key[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(np.r_[0, key[1:] != key[:-1]])
            ranks.append(rank)
            size *= 2
            if rank.max() == n - 1:
                break
        if order is None:
            order = np.argsort(ranks[0], kind="stable")
        top = int(text.max(initial=0))
        bwt = text[order - 1]                                # of the first suffix: the last symbol, a 0
        self.wavelet = WaveletMatrix(bwt, top)
        symbols = np.arange(top + 1)
        self.base = self.wavelet.place(symbols, np.zeros(top + 1, np.int64))
        self.first = np.r_[0, np.cumsum(np.bincount(text, minlength=top + 1))][:-1]
        # longest common prefixes of neighbours, from the ranks by halving steps
        a, b = order[:-1].copy(), order[1:].copy()
        lcp = np.zeros(n - 1, np.int64)
        for level in range(len(ranks) - 1, -1, -1):
            inside = (a < n) & (b < n)
            same = inside & (ranks[level][np.minimum(a, n - 1)] == ranks[level][np.minimum(b, n - 1)])
            step = np.where(same, 1 << level, 0)
            lcp += step
            a += step
            b += step
        self.lcp = np.r_[-1, np.minimum(lcp, depth), -1]
        self._limits()
        self._minima(owner[order])

    def _limits(self) -> None:
        """For each boundary the nearest ones of a smaller common prefix."""
        n = len(self.lcp)
        self.below = np.zeros(n, np.int32)
        self.above = np.full(n, n - 1, np.int32)
        for v in np.unique(self.lcp):
            if v <= 0:
                continue
            own = np.flatnonzero(self.lcp == v)
            less = np.flatnonzero(self.lcp < v)
            k = np.searchsorted(less, own)
            self.below[own], self.above[own] = less[k - 1], less[k]

    def _minima(self, values: np.ndarray) -> None:
        self.minima = [values.astype(np.int32)]
        size = 1
        while 2 * size <= len(values):
            last = self.minima[-1]
            self.minima.append(np.minimum(last[:-size], last[size:]))
            size *= 2

    def smallest(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Smallest rank in each interval; none may be empty."""
        level = np.frexp((hi - lo).astype(np.float64))[1] - 1
        out = np.empty(len(lo), np.int32)
        for k in np.unique(level):
            own = level == k
            out[own] = np.minimum(self.minima[k][lo[own]], self.minima[k][hi[own] - (1 << int(k))])
        return out

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the matches with one symbol more on their left."""
        both = self.wavelet.place(np.r_[symbol, symbol], np.r_[lo, hi])
        shift = self.first[symbol] - self.base[symbol]
        return both[:len(lo)] + shift, both[len(lo):] + shift

    def parent(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Enclosing intervals of shorter matches, and their lengths."""
        at = np.where(self.lcp[lo] >= self.lcp[hi], lo, hi)
        length = self.lcp[at]
        whole = length <= 0
        return (np.where(whole, 0, self.below[at]).astype(np.int64), np.where(whole, self.n, self.above[at]).astype(np.int64),
                np.maximum(length, 0))

    def matching_statistics(self, text: np.ndarray, start: np.ndarray, end: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """For each place of ``text`` within the parts [start, end): the length of the
        longest match that starts there, ends within the part and occurs in a part
        of a smaller rank than the part's own. All parts advance in step, from
        their right ends."""
        out = np.zeros(len(text), np.int32)
        order = np.argsort(start - end, kind="stable")       # longest first: the active ones are a prefix
        start, end, rank = start[order], end[order], rank[order]
        size = end - start
        lo, hi = np.zeros(len(start), np.int64), np.full(len(start), self.n, np.int64)
        length = np.zeros(len(start), np.int64)
        for step in range(1, int(size.max(initial=0)) + 1):
            active = int(np.searchsorted(-size, -step, "right"))
            at = end[:active] - step
            todo = np.arange(active)
            while len(todo):
                symbol = text[at[todo]]
                l, h = self.extend(symbol, lo[todo], hi[todo])
                good = h > l
                good[good] = self.smallest(l[good], h[good]) < rank[todo[good]]
                won = todo[good]
                lo[won], hi[won] = l[good], h[good]
                length[won] += 1
                lost = todo[~good]
                todo = lost[length[lost] > 0]
                lo[todo], hi[todo], length[todo] = self.parent(lo[todo], hi[todo])
            out[at] = length[:active]
        return out
