"""A bidirectional FM-index of a word sequence for phrases of up to three words, in numpy.

Places of the sequence are sorted by their next three symbols, forwards and backwards. That order is enough to
extend a phrase of one or two symbols: the places of a phrase are an interval of either order, and the symbols
that an order's transform holds in the interval are the phrase's extensions on one side: on the left in the order
of the text, on the right in that of its reverse. Intervals of many phrases are extended at once. An order is
built only where it is used."""

import numpy as np

from tarmac.llm.fm_index import Bits

#: Symbols that end a phrase: between two pieces, and any word that is too rare.
PIECE, RARE = 0, 1


class Extensions:
    """A wavelet matrix of a transform: all symbols of many intervals, with their counts."""

    def __init__(self, levels: list[Bits]):
        self.levels = levels

    @classmethod
    def of(cls, symbols: np.ndarray, depth: int):
        levels = []
        for level in range(depth - 1, -1, -1):
            bit = (symbols >> level) & 1 == 1
            levels.append(Bits(bit.astype(np.uint8)))
            symbols = np.concatenate([symbols[~bit], symbols[bit]])
        return cls(levels)

    def origins(self) -> np.ndarray:
        """Where each symbol starts after the last level."""
        at = np.zeros(1, np.int64)
        for bits in self.levels:
            one = bits.ones(at)
            at = np.stack([at - one, bits.zeros + one], 1).ravel()
        return at

    def of_intervals(self, lo: np.ndarray, hi: np.ndarray):
        """(interval, symbol, place of its first after the last level, count), by interval and symbol."""
        which, symbol = np.arange(len(lo)), np.zeros(len(lo), np.int64)
        for bits in self.levels:
            one_lo, one_hi = bits.ones(lo), bits.ones(hi)
            zero, one = np.flatnonzero(hi - one_hi > lo - one_lo), np.flatnonzero(one_hi > one_lo)
            lo, hi = (np.concatenate([(x - y)[zero], bits.zeros + y[one]]) for x, y in ((lo, one_lo), (hi, one_hi)))
            which, symbol = np.concatenate([which[zero], which[one]]), np.concatenate([symbol[zero] * 2, symbol[one] * 2 + 1])
        order = np.argsort(which << len(self.levels) | symbol)
        return which[order], symbol[order], lo[order], (hi - lo)[order]


class Order:
    """Of ``text``, symbols from 0; its ends are ``PIECE`` (the text is taken as a ring)."""

    def __init__(self, text: np.ndarray):
        text = text.astype(np.int64)
        size = int(text.max(initial=0)) + 1
        if size < 1 << 21:
            self.places = np.argsort((text * size + np.roll(text, -1)) * size + np.roll(text, -2))
        else:
            self.places = np.lexsort((np.roll(text, -2), np.roll(text, -1), text))
        self.text, self.counts = text.astype(np.int32), np.bincount(text)
        self.first = np.cumsum(self.counts) - self.counts
        self.extensions = Extensions.of(self.text[self.places - 1], max(1, size - 1).bit_length())

    def words(self):
        """(symbol, first place, count) of each word."""
        at = np.flatnonzero(self.counts[RARE + 1:]) + RARE + 1
        return at, self.first[at], self.counts[at]

    def pairs(self):
        """(symbol, next symbol, first place, count) of each two words in a row: runs of the order."""
        one, two = self.text[self.places], self.text[(self.places + 1) % len(self.text)]
        at = np.flatnonzero((np.diff(one, prepend=-1) != 0) | (np.diff(two, prepend=-1) != 0))
        n = np.diff(np.append(at, len(one)))
        word = (one[at] > RARE) & (two[at] > RARE)
        at, n = at[word], n[word]
        return one[at].astype(np.int64), two[at].astype(np.int64), at, n

    def extended(self, lo: np.ndarray, count: np.ndarray):
        """Phrases, intervals of ``count`` places from ``lo``, with each word that stands before them:
        (phrase, word, first place, count), by phrase and word."""
        which, symbol, place, n = self.extensions.of_intervals(lo, lo + count)
        word = symbol > RARE
        which, symbol = which[word], symbol[word]
        return which, symbol, self.first[symbol] + place[word] - self.extensions.origins()[symbol], n[word]

    def inside(self, lo: np.ndarray, count: np.ndarray, offset: int) -> np.ndarray:
        """At how many places of the intervals the symbol ``offset`` places on is no end of a piece."""
        ends = Bits((self.text[(self.places + offset) % len(self.text)] == PIECE).astype(np.uint8))
        return count - (ends.ones(lo + count) - ends.ones(lo))


def pairs(text: np.ndarray):
    """(word, next word, count, n_left, n_right) of two words in a row: words extended to the right."""
    x = Order(text[::-1])
    words, lo, count = x.words()
    which, second, lo, n = x.extended(lo, count)
    return words[which], second, n, x.inside(lo, n, 2), x.inside(lo, n, -1)


def triples(text: np.ndarray, use):
    """(word, next, next, count, n_left, n_right) of three words in a row, both pairs of which ``use`` (of two
    arrays of symbols) tells to use: pairs extended to the left."""
    x = Order(text)
    one, two, lo, count = x.pairs()
    good = use(one, two)
    one, two, lo, count = one[good], two[good], lo[good], count[good]
    which, before, lo, n = x.extended(lo, count)
    width = len(x.counts)
    known, new = one * width + two, before * width + one[which]  # ``known`` rises
    at = np.minimum(np.searchsorted(known, new), max(0, len(known) - 1))
    good = known[at] == new if len(known) else np.zeros(0, bool)
    which, before, lo, n = which[good], before[good], lo[good], n[good]
    return before, one[which], two[which], n, x.inside(lo, n, -1), x.inside(lo, n, 3)
