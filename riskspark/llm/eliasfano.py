"""Elias-Fano coded monotone sequences with vectorised access, in memory-mapped files."""

from __future__ import annotations

import os

import numpy as np

_POPCOUNT8 = np.array([bin(i).count("1") for i in range(256)], np.uint8)
#: place of the r-th set bit of a byte
_SELECT8 = np.array([[([i for i in range(8) if b >> i & 1] + [8] * 8)[r] for r in range(8)] for b in range(256)], np.uint8)


_ONES, _TOPS = np.uint64(0x0101010101010101), np.uint64(0x8080808080808080)


def _select_in_words(words: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Place of the set bit with the given rank in each 64-bit word, by sums of
    the bytes' set bits within the word."""
    rank = rank.astype(np.uint64)
    s = words - (words >> np.uint64(1) & np.uint64(0x5555555555555555))
    s = (s & np.uint64(0x3333333333333333)) + (s >> np.uint64(2) & np.uint64(0x3333333333333333))
    upto = (s + (s >> np.uint64(4)) & np.uint64(0x0F0F0F0F0F0F0F0F)) * _ONES  # set bits up to and with each byte
    passed = (rank * _ONES | _TOPS) - upto & _TOPS  # a top bit for each byte that ends before the wanted bit
    shift = np.minimum((passed >> np.uint64(7)) * _ONES >> np.uint64(56), np.uint64(7)) * np.uint64(8)
    before = (upto << np.uint64(8)) >> shift & np.uint64(0xFF)
    own = words >> shift & np.uint64(0xFF)
    return shift.astype(np.int64) + _SELECT8[own.astype(np.int64), np.minimum(rank - before, np.uint64(7)).astype(np.int64)]


class EliasFano:
    """A non-decreasing sequence of n integers below a universe u, in about
    2 + log2(u / n) bits each: low bits packed, high bits in unary, with the
    number of ones before each 64-bit word for selection."""

    def __init__(self, n: int, bits: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray):
        self.n, self.bits, self.low, self.high, self.ones = n, bits, low, high, ones

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.int64)
        n, top = len(values), int(values[-1]) + 1 if len(values) else 1
        bits = max(0, (top // max(n, 1)).bit_length() - 1)
        if bits:
            wide = (values & ((1 << bits) - 1)).astype("<u8").view(np.uint8).reshape(n, 8)
            low = np.packbits(np.unpackbits(wide, axis=1, bitorder="little")[:, :bits].ravel(), bitorder="little")
        else:
            low = np.empty(0, np.uint8)
        place = (values >> bits) + np.arange(n)
        flags = np.zeros(-(-((top >> bits) + n + 2) // 64) * 64, bool)
        flags[place] = True
        octets = np.packbits(flags, bitorder="little")
        per_word = _POPCOUNT8[octets].reshape(-1, 8).sum(axis=1, dtype=np.int64)
        low = np.concatenate([low, np.zeros(16 + -len(low) % 8, np.uint8)]).view("<u8")  # a word more than is read
        return cls(n, bits, low, octets.view("<u8"), np.cumsum(per_word) - per_word)

    def save(self, folder: str, name: str) -> EliasFano:
        """Writes the parts to files and returns the sequence memory-mapped."""
        parts = []
        for part in ("low", "high", "ones"):
            path = os.path.join(folder, f"{name}.{part}.npy")
            np.save(path, getattr(self, part))
            parts.append(np.asarray(np.load(path, mmap_mode="r")))
        return EliasFano(self.n, self.bits, *parts)

    def _lows(self, i: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(i), np.int64)
        at = i * self.bits
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        # the upper part is moved in two steps, as a shift by 64 is none
        both = self.low[word] >> shift | self.low[word + 1] << np.uint64(1) << (np.uint64(63) - shift)
        return (both & np.uint64((1 << self.bits) - 1)).astype(np.int64)

    def _select1(self, i: np.ndarray) -> np.ndarray:
        word = np.searchsorted(self.ones, i, side="right") - 1
        return word * 64 + _select_in_words(self.high[word], i - self.ones[word])

    def _select0(self, i: np.ndarray) -> np.ndarray:
        zeros = np.arange(len(self.ones), dtype=np.int64) * 64 - self.ones
        word = np.searchsorted(zeros, i, side="right") - 1
        return word * 64 + _select_in_words(~self.high[word], i - zeros[word])

    def get(self, i: np.ndarray) -> np.ndarray:
        """Values at the given indexes."""
        i = np.asarray(i, np.int64)
        return (self._select1(i) - i) << self.bits | self._lows(i) if len(i) else i

    def next_geq(self, x: np.ndarray) -> np.ndarray:
        """Index of the first value at or above each x (n if there is none)."""
        x = np.asarray(x, np.int64)
        out = np.full(len(x), self.n, np.int64)
        if not self.n or not len(x):
            return out
        highest = len(self.high) * 64 - self.n - 1  # last zero
        inside = np.flatnonzero((x >> self.bits) < highest)
        x = x[inside]
        h, low = x >> self.bits, x & ((1 << self.bits) - 1)
        lo = np.where(h > 0, self._select0(np.maximum(h - 1, 0)) - (h - 1), 0)
        hi = self._select0(h) - h
        while len(live := np.flatnonzero(lo < hi)):  # values of one high part ascend in their low bits
            mid = (lo[live] + hi[live]) >> 1
            less = self._lows(mid) < low[live]
            lo[live[less]] = mid[less] + 1
            hi[live[~less]] = mid[~less]
        out[inside] = lo
        return out
