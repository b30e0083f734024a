"""An FM-index over word ids: backward search on a wavelet matrix of packed bits.

Suffixes are sorted by their first ``depth`` words only. That is all a backward search needs for
patterns of up to ``depth`` words: of the suffixes that begin with a word, those whose rest sorts before
a shorter pattern stand before it.
"""

from __future__ import annotations

import numpy as np

_WORD = 64


def _paired(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Dense ranks of pairs."""
    return np.unique(first * (int(second.max(initial=0)) + 1) + second, return_inverse=True)[1].astype(np.int64)


def _ahead(ranks: np.ndarray, by: int) -> np.ndarray:
    return np.concatenate([ranks[by:], np.zeros(min(by, len(ranks)), dtype=np.int64)])


def prefix_ranks(symbols: np.ndarray, depth: int) -> np.ndarray:
    """The rank of every suffix by its first ``depth`` symbols, equal beginnings sharing one."""
    ranks, width, out = symbols.astype(np.int64), 1, None
    while True:
        if depth & width:
            out = ranks if out is None else _paired(ranks, _ahead(out, width))
        if 2 * width > depth:
            return out
        ranks, width = _paired(ranks, _ahead(ranks, width)), 2 * width


class WaveletMatrix:
    """Ranks in a sequence of symbols: a row of packed bits for each binary digit, highest first, and the ones
    before each word of them."""

    def __init__(self, symbols: np.ndarray, kinds: int):
        self.digits = list(range(max(1, int(kinds - 1).bit_length()) - 1, -1, -1))
        self.bits, self.before, self.zeros = [], [], []
        for digit in self.digits:
            ones = (symbols >> digit & 1).astype(bool)
            packed = np.packbits(ones, bitorder="little")
            packed = np.pad(packed, (0, 8 * (len(ones) // _WORD + 1) - len(packed))).view("<u8")
            self.bits.append(packed)
            self.before.append(np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)[:-1]]).astype(np.int32))
            self.zeros.append(len(ones) - int(np.count_nonzero(ones)))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])
        self.origin = self._descended(np.arange(kinds, dtype=np.int64), np.zeros(kinds, dtype=np.int64))

    def _descended(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for digit, bits, before, zeros in zip(self.digits, self.bits, self.before, self.zeros):
            word = at >> 6
            mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            ones = before[word] + np.bitwise_count(bits[word] & mask)
            at = np.where(symbols >> digit & 1, zeros + ones, at - ones)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        return self._descended(symbols, at) - self.origin[symbols]


class FmIndex:
    """Index over ``symbols``: ids from 1, with a 0 behind every document. ``ranks`` number the suffixes."""

    def __init__(self, symbols: np.ndarray, depth: int):
        symbols = symbols.astype(np.int64)
        self.depth, self.kinds = depth, int(symbols.max(initial=0)) + 1
        self.ranks = prefix_ranks(symbols, depth) if len(symbols) else symbols
        self.suffixes = np.argsort(self.ranks, kind="stable")
        self.wavelet = WaveletMatrix(symbols[self.suffixes - 1], self.kinds)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=self.kinds))])

    def matches(self, stream: np.ndarray, ends: np.ndarray, least: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``length, low, high`` for each end in ``stream``: how many symbols before it, up to ``depth``, make a
        string with ``least`` or more places in the index, and the interval of the suffixes that begin with it.

        A stream that is part of the index itself asks for two places, to see more than its own.
        """
        length = np.zeros(len(ends), dtype=np.int64)
        low, high = np.zeros(len(ends), dtype=np.int64), np.zeros(len(ends), dtype=np.int64)
        live = np.arange(len(ends))
        now_low, now_high = np.zeros(len(ends), dtype=np.int64), np.full(len(ends), len(self.suffixes), dtype=np.int64)
        for step in range(1, self.depth + 1):
            symbol = stream[np.maximum(ends[live] - step, 0)]
            known = (ends[live] >= step) & (symbol > 0) & (symbol < self.kinds)
            live, symbol, now_low, now_high = live[known], symbol[known], now_low[known], now_high[known]
            if step == 1:
                now_low, now_high = self.first[symbol], self.first[symbol + 1]
            else:
                both = self.wavelet.rank(np.concatenate([symbol, symbol]), np.concatenate([now_low, now_high]))
                now_low, now_high = (self.first[symbol] + part for part in np.split(both, 2))
            found = now_high - now_low >= least
            live, now_low, now_high = live[found], now_low[found], now_high[found]
            if not len(live):
                break
            length[live], low[live], high[live] = step, now_low, now_high
        return length, low, high
