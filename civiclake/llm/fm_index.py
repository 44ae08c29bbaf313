"""A compressed FM-index over word sequences: suffix order, Burrows-Wheeler transform, wavelet matrix, backward search."""

from __future__ import annotations

import numpy as np


class BitRank:
    """Bits packed 64 to a word with a running count a word."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        self.words = np.zeros(n // 64 + 1, np.uint64)
        packed = np.packbits(bits, bitorder="little")
        self.words.view(np.uint8)[: len(packed)] = packed
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(ones)])[:-1].astype(np.int32)
        self.zeros = n - int(ones.sum())

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        w = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & mask)


class WaveletMatrix:
    """Ranks of any symbol in a sequence, one packed bit row a level."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        self.levels = max(1, int(symbols - 1).bit_length())
        self.rows = []
        for level in range(self.levels - 1, -1, -1):
            bit = (sequence >> level) & 1 == 1
            self.rows.append(BitRank(bit))
            sequence = np.concatenate([sequence[~bit], sequence[bit]])
        self.start = self._down(np.arange(symbols), np.zeros(symbols, np.int64))

    def _down(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for k, row in enumerate(self.rows):
            one = (symbol >> (self.levels - 1 - k)) & 1 == 1
            ones = row.rank(i)
            i = np.where(one, row.zeros + ones, i - ones)
        return i

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each position."""
        return self._down(symbol, i) - self.start[symbol]


def _ranked(key: np.ndarray, bound: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Places in key order, each place's dense rank, and the highest rank; keys lie in 0 .. bound - 1."""
    n = len(key)
    shift = n.bit_length()
    if bound.bit_length() + shift <= 63:
        # A sort of numbers that carry their place is several times faster than a sort of places.
        both = np.sort(key << shift | np.arange(n))
        order, key = both & ((1 << shift) - 1), both >> shift
    else:
        order = np.argsort(key, kind="stable")
        key = key[order]
    new = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
    rank = np.empty(n, np.int64)
    rank[order] = new
    return order, rank, int(new[-1])


def suffix_order(text: np.ndarray, symbols: int, longest: int) -> np.ndarray:
    """Suffixes in the order of their first ``longest`` symbols at least, by doubling the compared length from two.

    The last symbol must be 0 and occur there only.
    """
    n = len(text)
    order, rank, top = _ranked(text * symbols + np.append(text[1:], 0), symbols * symbols)
    h = 2
    while h < longest and h < n and top < n - 1:
        nxt = np.zeros(n, np.int64)
        nxt[: n - h] = rank[h:] + 1
        order, rank, top = _ranked(rank * (top + 2) + nxt, (top + 1) * (top + 2))
        h *= 2
    return order


class FmIndex:
    """Tells which patterns up to ``longest`` symbols occur twice or more in a set of sequences.

    ``pieces`` are arrays of symbols >= 2, joined with separator 1 and closed with 0; ``often`` says which of them stand
    for more than one. Kept are the wavelet matrix of the transform, the place where each symbol's suffixes begin and
    one bit a suffix for ``often``: about one bit a symbol and level, and no text. Sorting by the first ``longest`` symbols
    is enough for patterns of that length: backward search only needs suffixes with different beginnings in order.
    """

    def __init__(self, pieces: list[np.ndarray], often: np.ndarray, symbols: int, longest: int):
        lengths = np.array([len(p) + 1 for p in pieces])
        text = np.ones(lengths.sum() + 1, np.int64)
        inside = np.ones(len(text) - 1, bool)
        inside[np.cumsum(lengths) - 1] = False
        text[:-1][inside] = np.concatenate(pieces)
        text[-1] = 0
        order = suffix_order(text, symbols, longest)
        self.bwt = WaveletMatrix(text[order - 1], symbols)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])
        self.often = BitRank(np.append(np.repeat(often, lengths), False)[order])
        self.n = len(text)

    def extend(self, lo: np.ndarray, hi: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of symbol + pattern from those of the patterns."""
        both = self.bwt.rank(np.concatenate([symbol, symbol]), np.concatenate([lo, hi]))
        base = self.first[symbol]
        return base + both[: len(lo)], base + both[len(lo) :]

    def repeated(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Whether intervals hold two suffixes or one of a piece that stands for more."""
        return hi - lo + self.often.rank(hi) - self.often.rank(lo) >= 2

    def reach(self, stream: np.ndarray, end: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Matching statistics of streamed symbols: how far left of ``end`` (not before ``stop``) the match still repeats.

        Gives, for each query, the smallest p >= stop such that stream[p..end] occurs twice (end + 1 if none does).
        """
        lo, hi = np.zeros(len(end), np.int64), np.full(len(end), self.n, np.int64)
        best = end + 1
        active = np.arange(len(end))
        while len(active):
            p = best[active] - 1
            a, b = self.extend(lo[active], hi[active], stream[p])
            good = self.repeated(a, b)
            active, a, b, p = active[good], a[good], b[good], p[good]
            lo[active], hi[active], best[active] = a, b, p
            active = active[p > stop[active]]
        return best


def repeated_windows(pieces: list[np.ndarray], weights: np.ndarray, symbols: int, window: int) -> np.ndarray:
    """For each piece, a bit mask of its windows (bit = window start) that occur twice or more by weight in all pieces.

    All windows of a piece that occurs twice itself repeat, so only the other pieces are streamed through the index.
    One backward search from a piece's end settles all windows right of where it ends. The rest goes from left to
    right: a search that ends at p shows that every window over it up to p occurs once, so the next start is p + 1.
    """
    often = weights >= 2
    index = FmIndex(pieces, often, symbols, max(map(len, pieces)))
    last = np.array([len(p) for p in pieces]) - window
    mask = np.zeros(len(pieces), np.uint64)

    def mark(which: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
        """Set bits a..b - 1."""
        full = lambda k: np.where(k >= 64, ~np.uint64(0), (np.uint64(1) << np.minimum(k, 63).astype(np.uint64)) - np.uint64(1))
        mask[which] |= full(b) & ~full(a)

    known = np.flatnonzero(often)
    mark(known, np.zeros(len(known), np.int64), last[known] + 1)
    every = np.flatnonzero(~often)
    if not len(every):
        return mask
    stream = np.concatenate([pieces[i] for i in every.tolist()])
    at = np.zeros(len(pieces), np.int64)
    at[every] = np.concatenate([[0], np.cumsum(last[every] + window)[:-1]])
    p = index.reach(stream, at[every] + last[every] + window - 1, at[every]) - at[every]
    mark(every, np.minimum(p, last[every] + 1), last[every] + 1)
    # Starts still open: 0 .. end - 1. The last window itself is settled.
    start, end = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
    end[every] = np.minimum(p, last[every])
    active = every[end[every] > 0]
    while len(active):
        s = start[active]
        here = at[active] + s
        p = index.reach(stream, here + window - 1, here) - at[active]
        alive = p <= s
        mark(active[alive], s[alive], s[alive] + 1)
        start[active] = np.where(alive, s + 1, p)
        active = active[start[active] < end[active]]
    return mask
