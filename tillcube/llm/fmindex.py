"""FM-index over integer sequences: suffix array, wavelet matrix, backward
search and location by sampled suffix positions.  All steps are vectorised,
so many patterns are searched in lockstep.
"""

from __future__ import annotations

import numpy as np


def suffix_array(sym: np.ndarray, snapshot: int = 0) -> tuple[np.ndarray, np.ndarray | None]:
    """Suffix array of ``sym`` by rank doubling over the still tied suffixes.

    Symbol 0 is a separator: each occurrence counts as a symbol of its own,
    smaller than all others and ordered by position, so no comparison
    passes one.  With ``snapshot`` = h (a power of two) the ranks by the
    first h symbols come back too.
    """
    n = len(sym)
    seps = np.flatnonzero(sym == 0)
    rank = sym.astype(np.int64) + len(seps)
    rank[seps] = np.arange(len(seps))
    order = np.argsort(rank, kind="stable")
    r = rank[order]
    heads = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1]])) if n else np.zeros(0, np.int64)
    size = np.diff(np.append(heads, n))
    rank[order] = np.repeat(heads, size)           # rank: first place of the tied group
    sa, shot, h = order, (rank.copy() if snapshot == 1 else None), 1
    tied = np.repeat(size > 1, size)
    places = np.flatnonzero(tied)                   # places of the array whose order is open
    while len(places):
        at = sa[places]
        nxt = np.where(at + h < n, rank[np.minimum(at + h, n - 1)], -1)
        head = rank[at]
        o = np.lexsort((nxt, head)) if n >= 1 << 31 else np.argsort((head << 32) | (nxt + 1), kind="stable")
        at, head, nxt = at[o], head[o], nxt[o]
        sa[places] = at
        new = np.concatenate([[True], (head[1:] != head[:-1]) | (nxt[1:] != nxt[:-1])])
        hd = np.flatnonzero(new)
        sz = np.diff(np.append(hd, len(at)))
        rank[at] = np.repeat(places[hd], sz)
        places = places[np.repeat(sz > 1, sz)]
        h *= 2
        if h == snapshot:
            shot = rank.copy()
    return sa, (shot if shot is not None or not snapshot else rank.copy())


class WaveletMatrix:
    """Rank over an integer sequence: one packed bit vector a level, the
    counts of ones before every 64-bit block beside it."""

    def __init__(self, seq: np.ndarray, sigma: int):
        self.n = len(seq)
        self.levels = max(1, int(sigma - 1).bit_length())
        self.words, self.ones, self.zeros = [], [], []
        cur = seq.astype(np.uint32)
        for lv in range(self.levels - 1, -1, -1):
            bit = ((cur >> np.uint32(lv)) & np.uint32(1)).astype(np.uint8)
            packed = np.packbits(bit, bitorder="little")
            packed = np.concatenate([packed, np.zeros(-len(packed) % 8 + 8, np.uint8)]).view(np.uint64)
            counts = np.bitwise_count(packed).astype(np.int32)
            self.words.append(packed)
            self.ones.append(np.concatenate([[0], np.cumsum(counts[:-1])]).astype(np.int32))
            self.zeros.append(int(self.n - bit.sum()))
            cur = np.concatenate([cur[bit == 0], cur[bit == 1]])

    def _rank1(self, k: int, i: np.ndarray) -> np.ndarray:
        w = i >> 6
        low = self.words[k][w] & ((np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1))
        return self.ones[k][w] + np.bitwise_count(low)

    def access(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols at places ``i`` and how often each occurs before its place."""
        i = i.astype(np.int64)
        lo = np.zeros_like(i)
        c = np.zeros_like(i)
        for k in range(self.levels):
            b = (self.words[k][i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)
            one = b.astype(bool)
            ri, rl = self._rank1(k, i), self._rank1(k, lo)
            i = np.where(one, self.zeros[k] + ri, i - ri)
            lo = np.where(one, self.zeros[k] + rl, lo - rl)
            c = (c << 1) | one
        return c, i - lo

    def rank_range(self, c: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences of ``c`` before ``lo`` and before ``hi``."""
        base = np.zeros_like(lo)
        for k in range(self.levels):
            one = ((c >> (self.levels - 1 - k)) & 1).astype(bool)
            rb, rl, rh = self._rank1(k, base), self._rank1(k, lo), self._rank1(k, hi)
            z = self.zeros[k]
            base = np.where(one, z + rb, base - rb)
            lo = np.where(one, z + rl, lo - rl)
            hi = np.where(one, z + rh, hi - rh)
        return lo - base, hi - base


class FMIndex:
    """Compressed index of a sequence over 0..sigma-1 (0 separates texts and
    must be the last symbol).  ``sample``: every text position divisible by
    it, and each first position of a text, keeps its place for ``locate``."""

    def __init__(self, sym: np.ndarray, sigma: int, sample: int = 0, sa: np.ndarray | None = None):
        n = self.n = len(sym)
        if sa is None:
            sa, _ = suffix_array(sym)
        bwt = sym[sa - 1]                    # sa = 0 wraps to the last separator
        self.first = np.concatenate([[0], np.cumsum(np.bincount(sym, minlength=sigma))]).astype(np.int64)
        self.wavelet = WaveletMatrix(bwt, sigma)
        if sample:
            keep = (sa % sample == 0) | (bwt == 0)
            bits = np.packbits(keep, bitorder="little")
            self.mark = np.concatenate([bits, np.zeros(-len(bits) % 8 + 8, np.uint8)]).view(np.uint64)
            c = np.bitwise_count(self.mark).astype(np.int64)
            self.mark_ones = np.concatenate([[0], np.cumsum(c[:-1])])
            self.sampled = sa[keep].astype(np.int32 if n < 1 << 31 else np.int64)

    def everything(self, lanes: int) -> tuple[np.ndarray, np.ndarray]:
        return np.zeros(lanes, np.int64), np.full(lanes, self.n, np.int64)

    def extend(self, c: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of ``c`` followed by what [lo, hi) stands for."""
        a, b = self.wavelet.rank_range(c, lo, hi)
        f = self.first[c]
        return f + a, f + b

    def search(self, patterns: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the patterns: rows of ``patterns``, right-aligned,
        symbol -1 for one that the text doesn't have."""
        width = patterns.shape[1]
        lo, hi = self.everything(len(patterns))
        for k in range(width - 1, -1, -1):
            on = np.flatnonzero((width - k <= lens) & (lo < hi))
            if not len(on):
                continue
            c = patterns[on, k].astype(np.int64)
            known = c >= 0
            hi[on[~known]] = lo[on[~known]]
            on, c = on[known], c[known]
            lo[on], hi[on] = self.extend(c, lo[on], hi[on])
        return lo, hi

    def locate(self, place: np.ndarray) -> np.ndarray:
        """Text positions of places of the suffix array, walking back to a sample."""
        place = place.astype(np.int64).copy()
        out = np.empty(len(place), np.int64)
        steps = np.zeros(len(place), np.int64)
        on = np.arange(len(place))
        while len(on):
            p = place[on]
            w = p >> 6
            word, bit = self.mark[w], (p & 63).astype(np.uint64)
            hit = ((word >> bit) & np.uint64(1)).astype(bool)
            r = self.mark_ones[w] + np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            out[on[hit]] = self.sampled[r[hit]] + steps[on[hit]]
            on = on[~hit]
            if len(on):
                c, before = self.wavelet.access(place[on])
                place[on] = self.first[c] + before
                steps[on] += 1
        return out
