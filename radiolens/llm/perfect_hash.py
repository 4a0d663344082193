"""Minimal perfect hashing of 64-bit keys in numpy.

Level by level every key left is hashed into a bit array of twice as many places; a key alone in
its place stays there, the others go on to the next level.  The slot of a key is the number of taken places before
its own over all levels, so n keys have the slots 0 .. n - 1.
"""

from __future__ import annotations

import numpy as np

from .common import mix64

ROOM = 2        # places per key of a level


def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix64(keys + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) % np.uint64(size)).astype(np.int64)


def build(keys: np.ndarray) -> tuple[list[int], bytes]:
    """``(sizes, bits)`` of the levels for distinct keys."""
    sizes, bits, left = [], [], keys.astype(np.uint64)
    while len(left):
        size = max(64, ROOM * len(left))
        at = _places(left, len(sizes), size)
        alone = np.bincount(at, minlength=size) == 1
        sizes.append(size)
        bits.append(alone)
        left = left[~alone[at]]
    return sizes, np.packbits(np.concatenate(bits)).tobytes() if bits else b""


class Slots:
    """Slots of keys under a built function."""

    def __init__(self, sizes: list[int], bits: bytes):
        self.sizes = sizes
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.taken = np.unpackbits(np.frombuffer(bits, np.uint8))[:int(self.starts[-1])].astype(bool)
        self.rank = np.concatenate([[0], np.cumsum(self.taken, dtype=np.int32)])

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 or some other key's slot for one that was not built in."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            if not len(left):
                break
            at = self.starts[level] + _places(keys[left], level, size)
            hit = self.taken[at]
            out[left[hit]] = self.rank[at[hit]]
            left = left[~hit]
        return out


def in_slot_order(keys: np.ndarray, slots: Slots) -> np.ndarray:
    out = np.empty(len(keys), np.uint64)
    out[slots(keys)] = keys
    return out
