"""A compressed full-text index of a shard of words: its Burrows-Wheeler transform in a wavelet matrix."""

from __future__ import annotations

import numpy as np

_ONE = np.uint64(1)


class _Bits:
    """A packed bit vector with counts of ones before each word of 64 bits."""

    def __init__(self, bits: np.ndarray) -> None:
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, np.uint64)
        self.words.view(np.uint8)[: len(packed)] = packed
        self.before = np.zeros(len(self.words), np.int32)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:])

    def ones_before(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        below = (_ONE << (at & 63).astype(np.uint64)) - _ONE
        return self.before[word] + np.bitwise_count(self.words[word] & below)


class _WaveletMatrix:
    """Ranks of symbols in a sequence, by one bit vector for each bit of a symbol."""

    def __init__(self, symbols: np.ndarray, alphabet: int) -> None:
        self.levels: list[tuple[int, _Bits, int]] = []
        start = np.zeros(alphabet, np.int64)
        codes = np.arange(alphabet)
        for shift in range(max(1, (alphabet - 1).bit_length()) - 1, -1, -1):
            bits = (symbols >> shift) & 1 == 1
            level = _Bits(bits)
            zeros = len(bits) - int(np.count_nonzero(bits))
            self.levels.append((shift, level, zeros))
            start = self._down(codes, start, shift, level, zeros)
            symbols = np.concatenate([symbols[~bits], symbols[bits]])
        self.start = start

    @staticmethod
    def _down(codes: np.ndarray, at: np.ndarray, shift: int, level: _Bits, zeros: int) -> np.ndarray:
        ones = level.ones_before(at)
        return np.where((codes >> shift) & 1, zeros + ones, at - ones)

    def rank(self, codes: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its position."""
        for shift, level, zeros in self.levels:
            at = self._down(codes, at, shift, level, zeros)
        return at - self.start[codes]


def _suffixes(text: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all suffixes, ordered by their first ``depth`` symbols at least."""
    n, rank, reach = len(text), text.astype(np.int64), 1
    while True:
        order = np.argsort(rank, kind="stable")
        ordered = rank[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.diff(ordered, prepend=ordered[0]) != 0)
        if reach >= depth or rank[order[-1]] == n - 1:
            return order
        further = np.zeros(n, np.int64)
        further[:-reach] = rank[reach:] + 1
        rank = rank * (n + 1) + further
        reach *= 2


class FMIndex:
    """Backward search over a text of symbols 1 to ``alphabet - 1``; 0 parts its pieces.

    Suffixes are ordered by their first ``depth`` symbols, which is all that searches
    of at most so many symbols need.
    """

    def __init__(self, text: np.ndarray, alphabet: int, depth: int) -> None:
        order = _suffixes(text, depth)
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=alphabet))])
        self.ranks = _WaveletMatrix(text[order - 1], alphabet)

    def matching_statistics(self, text: np.ndarray, ends: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """For each end in ``text`` (a text of this index), how far back it matches two places or more.

        Extends leftwards one symbol at a time and stops at ``limit`` or where one
        occurrence is left. The second result is where the interval of the whole match
        begins: equal matches of ``limit`` symbols have equal ones.
        """
        lengths, begins = np.zeros(len(ends), np.int64), np.zeros(len(ends), np.int64)
        live = np.arange(len(ends))
        low, high = np.zeros(len(ends), np.int64), np.full(len(ends), len(text))
        for step in range(limit):
            codes = text[ends[live] - 1 - step]
            both = self.ranks.rank(np.concatenate([codes, codes]), np.concatenate([low, high]))
            low, high = self.smaller[codes] + both[: len(live)], self.smaller[codes] + both[len(live) :]
            more = high - low > 1
            live, low, high = live[more], low[more], high[more]
            lengths[live] = step + 1
        begins[live] = low
        return lengths, begins
