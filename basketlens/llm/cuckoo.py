"""A cuckoo filter over 64-bit hashes with bulk insertion, lookup and deletion."""

from __future__ import annotations

import numpy as np

from basketlens.llm.common import mix

_U = np.uint64
SLOTS = 4


class CuckooFull(Exception):
    """An insertion found no slot; the filter must be rebuilt with more buckets."""


class CuckooFilter:
    """Buckets of four 16-bit fingerprints; 0 marks a free slot."""

    def __init__(self, table: np.ndarray) -> None:
        self.table = table

    @classmethod
    def for_keys(cls, n: int) -> CuckooFilter:
        """An empty filter that is at most half full with ``n`` keys."""
        buckets = 1 << max(4, int(np.ceil(np.log2(max(1, n) * 2 / SLOTS))))
        return cls(np.zeros((buckets, SLOTS), dtype=np.uint16))

    @classmethod
    def from_bytes(cls, data: bytes) -> CuckooFilter:
        return cls(np.frombuffer(data, dtype=np.uint16).reshape(-1, SLOTS).copy())

    def to_bytes(self) -> bytes:
        return self.table.tobytes()

    def __len__(self) -> int:
        return int((self.table != 0).sum())

    def _place(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        with np.errstate(over="ignore"):
            mixed = mix(hashes.astype(_U))
        prints = (mixed >> _U(48)).astype(np.uint16)
        prints[prints == 0] = 1
        return prints, (mixed & _U(len(self.table) - 1)).astype(np.int64)

    def _other(self, prints: np.ndarray, buckets: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return buckets ^ (mix(prints.astype(_U)) & _U(len(self.table) - 1)).astype(np.int64)

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        """False means certainly absent."""
        prints, first = self._place(hashes)
        second = self._other(prints, first)
        wanted = prints[:, None]
        return (self.table[first] == wanted).any(axis=1) | (self.table[second] == wanted).any(axis=1)

    def insert(self, hashes: np.ndarray) -> None:
        """Add distinct keys; all waiting keys try their bucket at once, then move or evict."""
        prints, buckets = self._place(hashes)
        random = np.random.default_rng(len(hashes))
        for attempt in range(1000):
            if len(prints) == 0:
                return
            order = np.argsort(buckets, kind="stable")
            prints, buckets = prints[order], buckets[order]
            starts = np.flatnonzero(np.concatenate([[True], buckets[1:] != buckets[:-1]]))
            rank = np.arange(len(buckets)) - np.repeat(starts, np.diff(np.append(starts, len(buckets))))
            free = self.table[buckets] == 0
            chosen = free & (np.cumsum(free, axis=1) == rank[:, None] + 1)
            placed = chosen.any(axis=1)
            self.table[buckets[placed], chosen[placed].argmax(axis=1)] = prints[placed]
            prints, buckets = prints[~placed], buckets[~placed]
            if attempt % 2 and len(prints):
                # One waiting key per bucket takes a random slot, its owner moves on.
                _, one = np.unique(buckets, return_index=True)
                slots = random.integers(0, SLOTS, len(one))
                evicted = self.table[buckets[one], slots].copy()
                self.table[buckets[one], slots] = prints[one]
                prints[one] = evicted
            buckets = self._other(prints, buckets)
        raise CuckooFull(f"{len(prints)} keys found no slot")

    def delete(self, hashes: np.ndarray) -> None:
        """Remove keys that were inserted before, one fingerprint each."""
        prints, first = self._place(hashes)
        second = self._other(prints, first)
        for value, a, b in zip(prints.tolist(), first.tolist(), second.tolist(), strict=True):
            for bucket in (a, b):
                at = np.flatnonzero(self.table[bucket] == value)
                if len(at):
                    self.table[bucket, at[0]] = 0
                    break
            else:
                raise KeyError("a key that is not in the filter cannot be deleted")
