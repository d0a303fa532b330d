"""Minimal perfect hash over distinct digests, by levels of lone positions.

Level by level the keys left over are hashed into twice as many positions; a
key that is alone on its position is placed there, the others go on.  The bits
of all levels stand back to back, and a key's slot is the number of set bits
before its own, so n keys get exactly the slots 0 to n-1.  A key that was not
in the set may also reach a slot: callers compare the full digest kept there.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

from .words import mix

_SPREAD = 2
_MOST_LEVELS = 64


class PerfectHash(NamedTuple):
    sizes: np.ndarray  # positions of each level
    bits: np.ndarray  # packed, all levels


def words_of(digests: np.ndarray) -> np.ndarray:
    """The first two 64-bit words of each digest (rows of bytes)."""
    return np.ascontiguousarray(digests[:, :16]).view("<u8")


def _position(words: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(words[:, 0] + mix(words[:, 1] + np.uint64(level))) % np.uint64(size)).astype(np.int64)


def build(digests: np.ndarray) -> tuple[PerfectHash, np.ndarray]:
    """The hash of distinct digests (n x at least 16 bytes) and each one's slot."""
    left = words_of(digests)
    sizes, levels = [], []
    while len(left):
        if len(sizes) == _MOST_LEVELS:
            raise ValueError("digests are not distinct")
        size = -(-_SPREAD * len(left) // 8) * 8
        at = _position(left, len(sizes), size)
        alone = np.bincount(at, minlength=size) == 1
        sizes.append(size)
        levels.append(alone)
        left = left[~alone[at]]
    bits = np.packbits(np.concatenate(levels)) if levels else np.empty(0, np.uint8)
    made = PerfectHash(np.array(sizes, np.int64), bits)
    return made, lookup(made, digests)


def lookup(made: PerfectHash, digests: np.ndarray) -> np.ndarray:
    """Each digest's slot; -1 where every level says that it was not in the set."""
    slots = np.full(len(digests), -1, np.int64)
    bits = np.unpackbits(made.bits).astype(bool)
    before = np.concatenate([[0], np.cumsum(bits)])
    words, open_, start = words_of(digests), np.arange(len(digests)), 0
    for level, size in enumerate(made.sizes.tolist()):
        at = start + _position(words[open_], level, size)
        here = bits[at]
        slots[open_[here]] = before[at[here]]
        open_ = open_[~here]
        start += size
    return slots
