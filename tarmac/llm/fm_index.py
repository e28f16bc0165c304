"""A compressed FM-index over word sequences, in numpy: suffix order by prefix doubling, the
Burrows-Wheeler transform in a wavelet matrix of packed bits, backward search for many patterns at once."""

import numpy as np


class Bits:
    """A bit vector of packed 64-bit words with the count of ones before each."""

    def __init__(self, bits: np.ndarray):
        n = len(bits) // 64 + 1
        padded = np.zeros(n * 64, np.uint8)
        padded[:len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words))[:-1]]).astype(np.int32)
        self.zeros = len(bits) - int(bits.sum())

    def ones(self, i: np.ndarray) -> np.ndarray:
        """How many ones there are before each place."""
        w = i >> 6
        below = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & below)


class FMIndex:
    """Of sequences of symbols (1 and up). Each sequence ends in a mark of its own, so no match runs on."""

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray, depth: int):
        """``depth``: the length of the matches that ``search`` reports."""
        n, m = len(symbols) + len(lengths), len(lengths)
        ends = np.cumsum(lengths + 1) - 1
        text = np.zeros(n, np.int64)
        inside = np.ones(n, bool)
        inside[ends] = False
        text[inside] = symbols
        rank = text + m - 1
        rank[ends] = np.arange(m)
        self.size, self.depth = n, depth
        h, at_16 = 1, None
        while True:
            if h == 16:
                at_16 = rank
            later = np.zeros(n, np.int64)
            later[:max(0, n - h)] = rank[h:] + 1
            key = rank * (n + m + int(text.max(initial=0)) + 2) + later
            order = np.argsort(key, kind="stable")
            new = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])]) if n else order
            rank = np.empty(n, np.int64)
            rank[order] = new
            h *= 2
            if h >= 32 and (not n or new[-1] == n - 1):
                break
        self.suffix = order.astype(np.int32)
        self.starts = {d: self._starts(at_16, d) for d in (depth - 1, depth)}
        bwt = text[self.suffix - 1]
        levels = max(1, int(text.max(initial=0)).bit_length())
        count = np.bincount(text, minlength=1 << levels)
        count[0] = m
        self.first = (np.cumsum(count) - count).astype(np.int64)
        self.levels, origin = [], np.zeros(1 << levels, np.int64)
        symbol = np.arange(1 << levels)
        for level in range(levels - 1, -1, -1):
            bit = (bwt >> level) & 1
            bits = Bits(bit.astype(np.uint8))
            self.levels.append((level, bits))
            bwt = np.concatenate([bwt[bit == 0], bwt[bit == 1]])
            one = bits.ones(origin)
            origin = np.where((symbol >> level) & 1 == 1, bits.zeros + one, origin - one)
        self.origin = origin

    def _starts(self, rank_16: np.ndarray, depth: int):
        """(class of each place of the suffix order, first place of each class): places whose first ``depth``
        symbols agree, told by the ranks of 16 symbols at both ends of them."""
        n = self.size
        far = np.full(n, -1, np.int64)
        far[:max(0, n - depth + 16)] = rank_16[depth - 16:]
        a, b = rank_16[self.suffix], far[self.suffix]
        new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])[:n]
        return (np.cumsum(new) - 1).astype(np.int32), np.concatenate([np.flatnonzero(new), [n]]).astype(np.int32)

    def step(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Where the suffixes before ``place`` go that ``symbol`` stands in front of."""
        i = place.astype(np.int64)
        for level, bits in self.levels:
            one = bits.ones(i)
            i = np.where((symbol >> level) & 1 == 1, bits.zeros + one, i - one)
        return self.first[symbol] + i - self.origin[symbol]

    def search(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Matching statistics of streams of symbols, read from their ends: the interval (lo, hi) of the suffix
        order of the ``depth`` symbols from each place; lo = hi where there are fewer or they do not occur.

        The interval of at most depth - 1 symbols is extended to the left; a longer match is first cut to
        depth - 1 by taking the class of that depth around it. After a failure a stream starts again from
        its last ``depth`` symbols, so that a later match is not lost.
        """
        ends = np.cumsum(lengths)
        lo_all, hi_all = np.zeros(len(symbols), np.int64), np.zeros(len(symbols), np.int64)
        at, begin = ends - 1, ends - lengths
        lo, hi, length = np.zeros(len(lengths), np.int64), np.full(len(lengths), self.size, np.int64), np.zeros(len(lengths), np.int64)
        cls, first = self.starts[self.depth - 1]
        live = np.flatnonzero(at >= begin)
        while len(live):
            c = symbols[at[live]]
            long = live[length[live] >= self.depth]
            if len(long):
                k = cls[lo[long]]
                lo[long], hi[long], length[long] = first[k], first[k + 1], self.depth - 1
            known = c < len(self.first)
            c = np.where(known, c, 0)
            a, b = self.step(c, lo[live]), self.step(c, hi[live])
            ok = known & (a < b)
            good, bad = live[ok], live[~ok]
            lo[good], hi[good] = a[ok], b[ok]
            length[good] += 1
            full = good[length[good] == self.depth]
            lo_all[at[full]], hi_all[at[full]] = lo[full], hi[full]
            at[good] -= 1
            if len(bad):  # the match of ``length`` symbols right of ``at`` ends here: go on with one symbol less
                short = length[bad] == 0
                at[bad] = np.where(short, at[bad] - 1, at[bad] + length[bad] - 1)
                lo[bad], hi[bad], length[bad] = 0, self.size, 0
            live = live[at[live] >= begin[live]]
        return lo_all, hi_all
