"""Cuckoo filter over 64-bit keys: membership with deletions, in numpy arrays."""

from __future__ import annotations

import numpy as np

from feederlens.llm.grams import mix

SLOTS = 4
#: Share of the slots in use above which the filter is made larger.
LOAD = 0.85
KICKS = 500


class CuckooFilter:
    """Buckets of four 16-bit fingerprints; 0 is an empty slot.

    A key may lie in two buckets, the second being the first one's number
    exclusive-or a hash of the fingerprint. Each key is to be added once (the
    exact table beside the filter knows); removing takes away one fingerprint.
    """

    def __init__(self, buckets: int, slots: np.ndarray | None = None):
        assert buckets & (buckets - 1) == 0
        self.buckets = buckets
        self.slots = np.zeros((buckets, SLOTS), np.uint16) if slots is None else slots
        self._kick = 0

    @classmethod
    def of(cls, keys: np.ndarray) -> CuckooFilter:
        """A filter with room for ``keys``, which it holds; doubled until all fit."""
        buckets = 1
        while buckets * SLOTS * LOAD < len(keys):
            buckets *= 2
        while True:
            made = cls(buckets)
            if made.add(keys):
                return made
            buckets *= 2

    @classmethod
    def load(cls, raw: bytes) -> CuckooFilter:
        slots = np.frombuffer(raw, np.uint16).reshape(-1, SLOTS).copy()
        return cls(len(slots), slots)

    def dump(self) -> bytes:
        return self.slots.tobytes()

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        hashed = mix(np.asarray(keys).astype(np.uint64, copy=False))
        prints = (hashed >> np.uint64(48)).astype(np.uint16)
        prints[prints == 0] = 1
        first = (hashed & np.uint64(self.buckets - 1)).astype(np.int64)
        return prints, first, self._other(first, prints)

    def _other(self, bucket, prints):
        jump = mix(np.asarray(prints, np.uint64)) & np.uint64(self.buckets - 1)
        return bucket ^ jump.astype(np.int64)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        """True for every key held, and for about one other in eight thousand."""
        prints, first, second = self._places(keys)
        here = (self.slots[first] == prints[:, None]).any(1)
        return here | (self.slots[second] == prints[:, None]).any(1)

    def add(self, keys: np.ndarray) -> bool:
        """Adds the keys; False if there is no room, and then the filter is to be made anew, larger."""
        prints, first, second = self._places(keys)
        left = np.arange(len(prints))
        # Rounds: each bucket takes one waiting key into its first free slot.
        for bucket in (first, second) * SLOTS:
            if not len(left):
                return True
            _, one = np.unique(bucket[left], return_index=True)
            chosen = left[one]
            at = bucket[chosen]
            free = self.slots[at] == 0
            fits = free.any(1)
            self.slots[at[fits], free[fits].argmax(1)] = prints[chosen[fits]]
            done = np.zeros(len(prints), bool)
            done[chosen[fits]] = True
            left = left[~done[left]]
        return all(self._push(int(first[i]), int(prints[i])) for i in left.tolist())

    def _push(self, bucket: int, mark: int) -> bool:
        for _ in range(KICKS):
            for at in (bucket, int(self._other(np.array([bucket]), np.array([mark]))[0])):
                free = np.flatnonzero(self.slots[at] == 0)
                if len(free):
                    self.slots[at, free[0]] = mark
                    return True
            bucket = at
            self._kick = (self._kick + 1) % SLOTS
            out = int(self.slots[bucket, self._kick])
            self.slots[bucket, self._kick] = mark
            bucket, mark = int(self._other(np.array([bucket]), np.array([out]))[0]), out
        return False

    def remove(self, keys: np.ndarray) -> None:
        """Removes keys that the filter holds; one that it does not hold is passed over."""
        prints, first, second = self._places(keys)
        for mark, one, two in zip(prints.tolist(), first.tolist(), second.tolist(), strict=True):
            for at in (one, two):
                held = np.flatnonzero(self.slots[at] == mark)
                if len(held):
                    self.slots[at, held[0]] = 0
                    break
