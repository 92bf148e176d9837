"""A compressed full-text index over word numbers: Burrows-Wheeler text in a wavelet matrix.

Suffixes are sorted by their first ``depth`` words only, which is all that patterns of up
to ``depth`` words need. Bits are packed, with one running count per 64 of them.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64
#: The number that stands between texts; no pattern holds it.
GAP = 0


class Bits:
    """A bit vector with constant-time counts of the ones before a place."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        ones = np.bitwise_count(self.words).astype(np.uint32)
        self.before = np.concatenate([[0], np.cumsum(ones)[:-1]]).astype(np.uint32)

    def ones(self, place: np.ndarray) -> np.ndarray:
        word = place >> 6
        low = (U64(1) << (place & 63).astype(U64)) - U64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & low).astype(np.int64)


class WaveletMatrix:
    """Counts of any symbol before any place in about ``log2`` of the alphabet steps."""

    def __init__(self, symbols: np.ndarray, alphabet: int):
        self.levels: list[tuple[int, Bits, int]] = []
        for level in reversed(range(max(1, int(alphabet - 1).bit_length()))):
            bit = ((symbols >> level) & 1).astype(bool)
            self.levels.append((level, Bits(bit), int(len(bit) - bit.sum())))
            symbols = np.concatenate([symbols[~bit], symbols[bit]])

    def count(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``first, before low, before high``: both counts are relative to ``first``, where the symbol's run begins."""
        n = len(symbol)
        places = np.concatenate([np.zeros(n, np.int64), low, high])
        wanted = np.concatenate([symbol, symbol, symbol])
        for level, bits, zeros in self.levels:
            ones = bits.ones(places)
            places = np.where((wanted >> level) & 1 == 1, zeros + ones, places - ones)
        return places[:n], places[n : 2 * n], places[2 * n :]


def _ranked_pairs(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Dense ranks of the pairs, and the order that sorts them."""
    joined = first * (int(second.max(initial=0)) + 1) + second
    order = np.argsort(joined, kind="stable")
    return _ranks(joined[order], order), order


def _ranks(ordered: np.ndarray, order: np.ndarray) -> np.ndarray:
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]])) if len(order) else 0
    return out


def _shifted(ranks: np.ndarray, by: int) -> np.ndarray:
    """Ranks ``by`` places on; behind the end stands what is less than everything."""
    out = np.zeros(len(ranks), np.int64)
    out[: max(0, len(ranks) - by)] = ranks[by:] + 1
    return out


def sorted_suffixes(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``suffixes, group, near``: suffixes in the order of their first ``depth`` words; numbers that agree for
    suffixes with equal first ``depth`` words; and whether a suffix's first ``depth - 1`` words differ from the one's before."""
    powers = {1: text.astype(np.int64)}
    while 2 * max(powers) <= depth:
        size = max(powers)
        powers[2 * size] = _ranked_pairs(powers[size], _shifted(powers[size], size))[0]

    def two_runs(length: int) -> tuple[np.ndarray, np.ndarray]:
        """Two overlapping runs cover any length."""
        size = max(x for x in powers if x <= length)
        return powers[size], _shifted(powers[size], length - size)

    group, order = _ranked_pairs(*two_runs(depth))
    differs = np.ones(len(order), bool)
    if depth > 1:
        runs = [run[order] for run in two_runs(depth - 1)]
        differs[1:] = (runs[0][1:] != runs[0][:-1]) | (runs[1][1:] != runs[1][:-1])
    else:
        differs[1:] = False
    return order, group[order], differs


class FMIndex:
    """Over one text of word numbers (``GAP`` between texts), for patterns of up to ``depth`` words."""

    def __init__(self, text: np.ndarray, depth: int):
        self.depth = depth
        self.suffixes, self.group, first = sorted_suffixes(text, depth)
        alphabet = int(text.max(initial=0)) + 1
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=alphabet))])
        self.matrix = WaveletMatrix(text[self.suffixes - 1], alphabet)
        bounds = np.flatnonzero(first)
        inside = np.cumsum(first) - 1
        self.near_low, self.near_high = bounds[inside], np.concatenate([bounds[1:], [len(first)]])[inside]

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One backward step: the suffixes that have ``symbol`` before what ``low`` to ``high`` begin with."""
        first, before_low, before_high = self.matrix.count(symbol, low, high)
        return self.starts[symbol] + before_low - first, self.starts[symbol] + before_high - first

    def shorten(self, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes that agree in one word less than ``depth``: drops a full match's last word."""
        return self.near_low[low], self.near_high[low]

    def matching_statistics(self, patterns: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``length, low``: for every place of every pattern, how many words from there on the index has, up to ``depth``.

        Patterns are rows, padded with ``GAP`` behind their size. All rows take a backward step at once, from
        their ends on. A match of ``depth`` words loses its last word before the next step; a step
        that finds nothing begins anew with the words that follow, less one at a time.
        ``low`` is the first suffix of the match.
        """
        rows, width = patterns.shape
        length, place = np.zeros((rows, width), np.int16), np.zeros((rows, width), np.int64)
        low, high = np.zeros(rows, np.int64), np.full(rows, len(self.suffixes), np.int64)
        size = np.zeros(rows, np.int64)
        for at in reversed(range(width)):
            live = np.flatnonzero(at < sizes)
            if len(live) == 0:
                continue
            full = live[size[live] == self.depth]
            low[full], high[full] = self.shorten(low[full])
            size[full] -= 1
            new_low, new_high = self.extend(patterns[live, at], low[live], high[live])
            hit = new_low < new_high
            good = live[hit]
            low[good], high[good] = new_low[hit], new_high[hit]
            size[good] += 1
            for row in live[~hit].tolist():
                low[row], high[row], size[row] = self._longest(patterns[row, at : at + size[row] + 1])
            length[live, at], place[live, at] = size[live], low[live]
        return length, place

    def _longest(self, words: np.ndarray) -> tuple[int, int, int]:
        """The longest prefix of ``words`` that the index has."""
        for size in range(len(words) - 1, 0, -1):
            low, high = np.zeros(1, np.int64), np.full(1, len(self.suffixes))
            for word in words[:size][::-1]:
                low, high = self.extend(np.array([word]), low, high)
                if low[0] >= high[0]:
                    break
            else:
                return int(low[0]), int(high[0]), size
        return 0, len(self.suffixes), 0
