"""A minimal perfect hash of 64-bit keys: levels of bit fields, three bits or so a key.

On each level a key falls on one bit. Keys alone on theirs are settled, the rest
go to the next level. A key's number is how many bits are set before its own, found by one
popcount, so a look-up takes the same few steps however many keys there are.
"""

from __future__ import annotations

import numpy as np

from logbrook.llm.batches import mixed

ROOM = 2
"""Bits per unsettled key on each level."""

MOST_LEVELS = 64
FINGERPRINT = np.uint64(0x5851F42D4C957F2D)


def build(keys: np.ndarray) -> dict[str, np.ndarray]:
    """The hash's arrays: ``words`` of bits, ``ranks`` before each, ``levels`` as first word and bits."""
    left = np.unique(keys.astype(np.uint64))
    words, levels = [], []
    first = 0
    for level in range(MOST_LEVELS):
        if not len(left):
            break
        bits = -(-len(left) * ROOM // 64) * 64
        at = _place(left, level, bits)
        alone = np.bincount(at.astype(np.int64), minlength=bits) == 1
        words.append(np.packbits(alone, bitorder="little").view("<u8"))
        levels.append((first, bits))
        first += bits // 64
        left = left[~alone[at.astype(np.int64)]]
    if len(left):
        raise ValueError("keys that no level tells apart")
    joined = np.concatenate(words) if words else np.zeros(0, np.uint64)
    counted = np.bitwise_count(joined).astype(np.uint32)
    ranks = (np.cumsum(counted) - counted).astype(np.uint32)
    return {"words": joined, "ranks": ranks, "levels": np.array(levels, np.int64).reshape(-1, 2)}


def _place(keys: np.ndarray, level: int, bits: int) -> np.ndarray:
    return mixed(keys ^ mixed(np.array([level], np.uint64))) % np.uint64(bits)


def number(index: dict[str, np.ndarray], keys: np.ndarray) -> np.ndarray:
    """Each key's number, from 0 without gaps; any number or -1 for keys that were not there."""
    keys = keys.astype(np.uint64)
    found = np.full(len(keys), -1, np.int64)
    todo = np.arange(len(keys))
    for level, (first, bits) in enumerate(index["levels"].tolist()):
        at = _place(keys[todo], level, bits)
        word = first + (at >> np.uint64(6)).astype(np.int64)
        bit = at & np.uint64(63)
        set_ = (index["words"][word] >> bit) & np.uint64(1) == 1
        below = index["words"][word] & ((np.uint64(1) << bit) - np.uint64(1))
        found[todo[set_]] = (index["ranks"][word] + np.bitwise_count(below))[set_]
        todo = todo[~set_]
    return found


def fingerprint(keys: np.ndarray) -> np.ndarray:
    """32 bits that tell a key from one that was not there."""
    return (mixed(keys.astype(np.uint64) ^ FINGERPRINT) >> np.uint64(32)).astype(np.uint32)
