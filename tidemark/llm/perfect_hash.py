"""A minimal perfect hash over 64-bit keys, by levels of bit arrays (the published BBHash scheme).

Every level hashes the keys left over to twice as many places; a place hit by one key is
that key's, the others go on to the next level. A key's slot is the number of places taken before its own.
"""

from __future__ import annotations

import io

import numpy as np

from tidemark.llm.words import mix

GAMMA = 2
_MOST_LEVELS = 64


def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(keys ^ mix(np.array([level + 1], np.uint64))) % np.uint64(size)).astype(np.int64)


def _fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mix(keys ^ np.uint64(0x94D049BB133111EB)) >> np.uint64(32)).astype(np.uint32)


class PerfectHash:
    """``slots(keys)`` gives each key's slot below the number of keys, or -1 if the stored fingerprint says it is none of them."""

    def __init__(self, levels: list[np.ndarray], fingerprints: np.ndarray):
        self.levels, self.fingerprints = levels, fingerprints
        taken = np.cumsum([0, *(int(level.sum()) for level in levels)])
        self.ranks = [np.cumsum(level) - 1 + before for level, before in zip(levels, taken)]

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """``keys`` are distinct unsigned 64-bit numbers."""
        levels, left = [], keys
        while len(left):
            if len(levels) == _MOST_LEVELS:
                raise ValueError("keys are not distinct")
            places = _places(left, len(levels), GAMMA * len(left) + 1)
            levels.append(np.bincount(places, minlength=GAMMA * len(left) + 1) == 1)
            left = left[~levels[-1][places]]
        own = cls(levels, np.zeros(len(keys), np.uint32))
        own.fingerprints[own._find(keys)] = _fingerprints(keys)
        return own

    def _find(self, keys: np.ndarray) -> np.ndarray:
        slots, open_ = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for k, (level, rank) in enumerate(zip(self.levels, self.ranks)):
            places = _places(keys[open_], k, len(level))
            here = level[places]
            slots[open_[here]] = rank[places[here]]
            open_ = open_[~here]
        return slots

    def slots(self, keys: np.ndarray) -> np.ndarray:
        found = self._find(keys)
        known = found >= 0
        known[known] = self.fingerprints[found[known]] == _fingerprints(keys[known])
        return np.where(known, found, -1)

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        sizes = np.array([len(self.fingerprints), len(self.levels), *map(len, self.levels)], np.int64)
        out.write(np.int64(len(sizes)).tobytes() + sizes.tobytes())
        for level in self.levels:
            out.write(np.packbits(level, bitorder="little").tobytes())
        out.write(self.fingerprints.tobytes())
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> tuple[PerfectHash, int]:
        """The hash, and where its bytes end."""
        count = int(np.frombuffer(data, np.int64, 1)[0])
        keys, _, *widths = np.frombuffer(data, np.int64, count, 8).tolist()
        at, levels = 8 + 8 * count, []
        for width in widths:
            size = (width + 7) // 8
            levels.append(np.unpackbits(np.frombuffer(data, np.uint8, size, at), count=width, bitorder="little").view(bool))
            at += size
        return cls(levels, np.frombuffer(data, np.uint32, keys, at).copy()), at + 4 * keys
