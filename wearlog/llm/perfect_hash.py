"""A minimal perfect hash over distinct 64-bit keys, built and probed with whole arrays.

Each level is a bit map of about ``ROOM`` bits a key. A key whose bit no other key of the level
wants is placed there, the others go on to the next level; a key's slot is the number of set bits
before its own. Keys that are still without a bit after ``LEVELS`` levels take the last slots, in order.
"""

from dataclasses import dataclass

import numpy as np

from wearlog.llm.flat import U64, splitmix

ROOM, LEVELS, BLOCK = 2, 24, 512


def _bit(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (splitmix(keys ^ splitmix(np.array([level], U64))) % U64(size)).astype(np.int64)


def fingerprints(keys: np.ndarray) -> np.ndarray:
    """32 bits of each key that do not depend on its bits in the levels."""
    return (splitmix(keys ^ U64(0xA5A5A5A5A5A5A5A5)) >> U64(32)).astype(np.uint32)


@dataclass
class PerfectHash:
    sizes: np.ndarray
    """Bits of each level."""
    bits: np.ndarray
    """All levels, packed."""
    before: np.ndarray
    """Set bits before each block."""
    rest: np.ndarray
    """Sorted keys without a bit."""

    @classmethod
    def build(cls, keys: np.ndarray) -> "PerfectHash":
        """``keys``: distinct, unsigned 64 bits."""
        maps, sizes = [], []
        for level in range(LEVELS):
            if len(keys) == 0:
                break
            size = max(64, ROOM * len(keys))
            at = _bit(keys, level, size)
            alone = np.bincount(at, minlength=size) == 1
            maps.append(alone)
            sizes.append(size)
            keys = keys[~alone[at]]
        bits = np.concatenate(maps) if maps else np.zeros(0, bool)
        bits = np.pad(bits, (0, -len(bits) % BLOCK))
        counts = bits.reshape(-1, BLOCK).sum(axis=1)
        before = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        return cls(np.array(sizes, np.int64), np.packbits(bits), before, np.sort(keys))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; a key it was not built for gets some slot or -1."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        start = 0
        for level, size in enumerate(self.sizes.tolist()):
            at = start + _bit(keys[left], level, size)
            hit = (self.bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
            out[left[hit]] = self._rank(at[hit])
            left = left[~hit]
            start += size
        place = np.searchsorted(self.rest, keys[left])
        known = place < len(self.rest)
        known[known] = self.rest[place[known]] == keys[left[known]]
        out[left[known]] = self.before[-1] + place[known]
        return out

    def _rank(self, at: np.ndarray) -> np.ndarray:
        block = at // BLOCK
        rows = np.unpackbits(self.bits.reshape(-1, BLOCK // 8)[block], axis=1)
        rows[np.arange(BLOCK)[None, :] >= (at - block * BLOCK)[:, None]] = 0
        return self.before[block] + rows.sum(axis=1)
