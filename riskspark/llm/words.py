"""Vectorised words of whole texts: boundaries and 64-bit hashes.

A word is ``[^\\x20\\x09-\\x0D]+``; the separators are ASCII bytes, so words can be
found in UTF-8 bytes directly.  Hashes are polynomials in an odd base modulo
2^64, finished by a mixing step, and depend on the word's bytes alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15 | 1
_PIECE = 1 << 20

SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True

#: For normalised words: everything in ASCII but letters and digits separates.
NOT_ALNUM = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finisher (shift, multiply, shift)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts back to back, and len+1 offsets; NULL is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    arr = texts.cast(pa.large_string()).fill_null("")
    if not len(arr):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset : arr.offset + len(arr) + 1]
    body = arr.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _pieces(data: np.ndarray, separates: np.ndarray, starts: np.ndarray):
    """Cuts of the bytes at document starts or separators, about _PIECE apart."""
    at, n = 0, len(data)
    while at < n:
        end = min(n, at + _PIECE)
        while end < n:
            stop = min(n, end + 4096)
            near = np.flatnonzero(separates[data[end:stop]] | starts[end:stop])
            if len(near):
                end += int(near[0])
                break
            end = stop
        yield at, end
        at = end


class Words:
    """Words of a batch of texts.

    ``start``/``end``: byte positions in ``data``; ``hash``: uint64;
    ``first``: for each document the index of its first word (len+1 entries).
    """

    def __init__(self, texts: pa.Array, lower: bool = False, separates: np.ndarray = SPACES):
        data, offsets = buffers(texts)
        self.data = _LOWER[data] if lower else data
        fresh = np.zeros(len(data) + 1, bool)
        fresh[offsets] = True
        starts, ends, hashes = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
        for a, b in _pieces(self.data, separates, fresh):
            part = self.data[a:b]
            inside = ~separates[part]
            joined = np.zeros(len(part), bool)  # continues the word of the byte before
            joined[1:] = inside[1:] & inside[:-1] & ~fresh[a + 1 : b]
            begins = np.flatnonzero(inside & ~joined)
            if not len(begins):
                continue
            goes_on = np.zeros(len(part), bool)
            goes_on[:-1] = joined[1:]
            stops = np.flatnonzero(inside & ~goes_on) + 1
            sizes = stops - begins
            firsts = np.cumsum(sizes) - sizes
            place = np.arange(int(sizes.sum())) - np.repeat(firsts, sizes)
            values = (part[inside].astype(np.uint64) + np.uint64(1)) * powers(_BASE, int(sizes.max()))[place]
            starts.append(begins + a)
            ends.append(stops + a)
            hashes.append(mix(np.add.reduceat(values, firsts) + sizes.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
        self.start, self.end, self.hash = (np.concatenate(x) for x in (starts, ends, hashes))
        self.first = np.searchsorted(self.start, offsets)
        # a document that starts inside the separators of none: words start at or after its offset
        self.count = np.diff(self.first)

    def doc(self) -> np.ndarray:
        """Each word's document index."""
        return np.repeat(np.arange(len(self.count)), self.count)


def windows(hashes: np.ndarray, first: np.ndarray, length: int, base: int = 0xD1342543DE82EF95) -> tuple[np.ndarray, np.ndarray]:
    """Karp-Rabin hashes of every run of ``length`` words inside one document:
    (index of the first word, hash), by a rolling polynomial modulo 2^64."""
    n = len(hashes)
    if n < length:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    inverse = pow(base, -1, 1 << 64)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * powers(inverse, n), dtype=np.uint64)])
    at = np.arange(n - length + 1)
    limit = np.repeat(first[1:], np.diff(first))[: n - length + 1]
    at = at[at + length <= limit]
    # base^-j inside the sum times base^start leaves base^-(place in the window)
    return at, mix((sums[at + length] - sums[at]) * powers(base, n)[at])
