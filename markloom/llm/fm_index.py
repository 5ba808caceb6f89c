"""A word FM-index in numpy: suffix sorting, wavelet matrix, backward search, sampled suffix positions."""

from __future__ import annotations

import numpy as np

#: Every so many words a suffix position is kept.
SAMPLE = 16


def suffix_array(text: np.ndarray, sigma: int) -> np.ndarray:
    """Sorted suffixes of a text that ends with its unique least symbol 0.

    The first sort compares as many symbols as fit 63 bits; after that only suffixes that still tie are
    sorted again, by the ranks of what follows them, over twice the length each round.
    """
    n = len(text)
    bits = max(1, int(sigma - 1).bit_length())
    h = max(1, 63 // bits)
    padded = np.concatenate((text, np.zeros(h, np.int64)))
    key = np.zeros(n, np.int64)
    for j in range(h):
        key <<= bits
        key |= padded[j : j + n]
    order = np.argsort(key)
    key = key[order]
    fresh = np.concatenate(([True], key[1:] != key[:-1]))
    first = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = first
    slots = _tied(np.arange(n), fresh)
    while len(slots):
        own = order[slots]
        key = rank[own] * n + rank[np.minimum(own + h, n - 1)]
        by = np.argsort(key)
        own, key = own[by], key[by]
        order[slots] = own
        fresh = np.concatenate(([True], key[1:] != key[:-1]))
        rank[own] = slots[np.maximum.accumulate(np.where(fresh, np.arange(len(slots)), 0))]
        slots = _tied(slots, fresh)
        h *= 2
    return order


def _tied(slots: np.ndarray, fresh: np.ndarray) -> np.ndarray:
    """Slots whose group, begun where ``fresh``, has several members."""
    last = np.concatenate((fresh[1:], [True]))
    return slots[~(fresh & last)]


class FMIndex:
    """Index of texts given as one array of word hashes and the places where texts begin."""

    def __init__(self, words: np.ndarray, bounds: np.ndarray):
        self.vocabulary, ids = np.unique(words, return_inverse=True)
        docs = len(bounds) - 1
        #: Words are numbered from 2; 1 stands between texts, 0 ends the whole.
        text = np.ones(len(words) + docs + 1, np.int64)
        self.begins = bounds[:-1] + np.arange(docs)
        text[np.arange(len(words)) + np.repeat(np.arange(docs), np.diff(bounds))] = ids + 2
        text[-1] = 0
        sigma = len(self.vocabulary) + 2
        order = suffix_array(text, sigma)
        last = text[order - 1].astype(np.int32)
        self.size = len(text)
        self.less = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=sigma))))
        self.levels: list[tuple[int, np.ndarray, int]] = []
        for b in range(max(1, int(sigma - 1).bit_length()) - 1, -1, -1):
            one = (last >> b) & 1
            ones = np.zeros(self.size + 1, np.int32)
            np.cumsum(one, out=ones[1:])
            zeros = self.size - int(ones[-1])
            self.levels.append((b, ones, zeros))
            one = one.astype(bool)
            parted = np.empty_like(last)
            np.compress(~one, last, out=parted[:zeros])
            np.compress(one, last, out=parted[zeros:])
            last = parted
        marked = order % SAMPLE == 0
        self.mark_rank = np.zeros(self.size + 1, np.int32)
        np.cumsum(marked.astype(np.int32), out=self.mark_rank[1:])
        self.samples = order[marked]

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before a place of the transformed text."""
        begin = np.zeros_like(at)
        for b, ones, zeros in self.levels:
            bit = ((symbol >> b) & 1).astype(bool)
            i, j = ones[at], ones[begin]
            at = np.where(bit, zeros + i, at - i)
            begin = np.where(bit, zeros + j, begin - j)
        return at - begin

    def back(self, row: np.ndarray) -> np.ndarray:
        """The row of the suffix that begins one word earlier."""
        symbol, at, begin = np.zeros_like(row), row, np.zeros_like(row)
        for b, ones, zeros in self.levels:
            i, j = ones[at], ones[begin]
            bit = (ones[at + 1] - i).astype(bool)
            symbol |= np.where(bit, 1 << b, 0)
            at = np.where(bit, zeros + i, at - i)
            begin = np.where(bit, zeros + j, begin - j)
        return self.less[symbol] + at - begin

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Backward search of phrases (word hashes, aligned to the right): those that occur, and their rows [lo, hi)."""
        place = np.minimum(np.searchsorted(self.vocabulary, phrases), max(0, len(self.vocabulary) - 1))
        known = self.vocabulary[place] == phrases if len(self.vocabulary) else np.zeros(phrases.shape, bool)
        width = phrases.shape[1]
        needed = np.arange(width)[None, :] >= width - lengths[:, None]
        alive = np.flatnonzero((known | ~needed).all(1) & (lengths > 0))
        lo, hi = np.zeros(len(alive), np.int64), np.full(len(alive), self.size, np.int64)
        for j in range(width - 1, -1, -1):
            step = needed[alive, j]
            if not step.any():
                break
            c = place[alive[step], j] + 2
            lo[step] = self.less[c] + self.rank(c, lo[step])
            hi[step] = self.less[c] + self.rank(c, hi[step])
            keep = lo < hi
            alive, lo, hi = alive[keep], lo[keep], hi[keep]
        return alive, lo, hi

    def locate(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Text places of all rows of the ranges, and the range that each belongs to."""
        counts = hi - lo
        owner = np.repeat(np.arange(len(lo)), counts)
        row = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + lo[owner]
        place, pending = np.zeros(len(row), np.int64), np.arange(len(row))
        for steps in range(SAMPLE):
            at = self.mark_rank[row]
            hit = self.mark_rank[row + 1] > at
            place[pending[hit]] = self.samples[at[hit]] + steps
            pending, row = pending[~hit], row[~hit]
            if not len(row):
                break
            row = self.back(row)
        return place, owner
