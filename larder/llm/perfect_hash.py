"""A minimal perfect hash over 128-bit keys, built and probed with whole arrays.

Level by level, every key not yet placed marks a bit of a fresh bit array. A bit marked by one key
alone keeps that key; the others go on to the next, smaller level. The rank of a key's bit among
all kept bits is its slot, so ``n`` keys fill slots 0 to n - 1. A key outside the set may reach any
slot, which is what the fingerprints stored beside the slots are for.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np

#: Bits of a level for each key that reaches it.
BITS_PER_KEY = 2


def mix(high: np.ndarray, low: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of both halves of a key; another one for each seed."""
    with np.errstate(over="ignore"):
        x = high ^ (low * np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64((seed * 0xD1B54A32D192ED03) % 2**64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class PerfectHash:
    """``levels``: one bool array each; ``before``: kept bits ahead of each level."""

    levels: list[np.ndarray]

    def __post_init__(self) -> None:
        self.ranks, ahead = [], 0
        for bits in self.levels:
            self.ranks.append(np.cumsum(bits) - bits + ahead)
            ahead += int(bits.sum())
        self.size = ahead

    def slots(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 where no level holds it (then it is not in the set)."""
        found = np.full(len(high), -1, np.int64)
        left = np.arange(len(high))
        for seed, (bits, ranks) in enumerate(zip(self.levels, self.ranks)):
            at = mix(high[left], low[left], seed) % np.uint64(len(bits))
            hit = bits[at]
            found[left[hit]] = ranks[at[hit]]
            left = left[~hit]
        return found

    def to_bytes(self) -> bytes:
        head = struct.pack(f"<I{len(self.levels)}I", len(self.levels), *map(len, self.levels))
        return head + b"".join(np.packbits(bits).tobytes() for bits in self.levels)

    @staticmethod
    def from_bytes(raw: bytes) -> PerfectHash:
        (count,) = struct.unpack_from("<I", raw)
        sizes, at, levels = struct.unpack_from(f"<{count}I", raw, 4), 4 + 4 * count, []
        for size in sizes:
            packed = np.frombuffer(raw, np.uint8, (size + 7) // 8, at)
            levels.append(np.unpackbits(packed, count=size).astype(bool))
            at += len(packed)
        return PerfectHash(levels)


def build(high: np.ndarray, low: np.ndarray) -> PerfectHash:
    """A hash over distinct keys; ends for certain only if they are distinct."""
    levels: list[np.ndarray] = []
    while len(high):
        size = max(8, BITS_PER_KEY * len(high))
        at = mix(high, low, len(levels)) % np.uint64(size)
        alone = np.bincount(at.astype(np.int64), minlength=size) == 1
        levels.append(alone)
        again = ~alone[at]
        high, low = high[again], low[again]
    return PerfectHash(levels)
