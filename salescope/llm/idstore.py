"""A bounded store of the ids of strings that a worker has met, as flat arrays."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import repeat

import numpy as np
import pyarrow as pa

# Distinct strings in each of the two generations that a worker keeps.
STORED = 200_000


def gathered(first: np.ndarray, ids: np.ndarray, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all slots one after the other, and the slots' offsets in them."""
    starts = first[slots]
    counts = first[slots + 1] - starts
    bounds = np.concatenate(([0], np.cumsum(counts)))
    places = np.repeat(starts - bounds[:-1], counts)
    places += np.arange(len(places))
    return ids[places], bounds


class _Generation:
    def __init__(self) -> None:
        self.places: dict[bytes, int] = {}
        self.first = np.zeros(1, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.int32)

    def find(self, strings: Sequence[bytes]) -> np.ndarray:
        return np.fromiter(map(self.places.get, strings, repeat(-1)), dtype=np.int64, count=len(strings))

    def add(self, strings: Sequence[bytes], ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        slots = len(self.first) - 1 + np.arange(len(strings))
        self.first = np.concatenate((self.first, self.first[-1] + np.cumsum(counts)))
        self.ids = np.concatenate((self.ids, ids.astype(np.int32)))
        self.places.update(zip(strings, slots.tolist()))
        return slots


class IdStore:
    """Looks up the ids of many strings at once; ``make`` gives the ids of new ones, flat, and their counts.

    When a generation is full it becomes the old one, and only strings that are met again move on from it, so
    frequent strings stay and rare ones go.
    """

    def __init__(self, make: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], most: int = STORED):
        self.make, self.most = make, most
        self.new, self.old = _Generation(), _Generation()

    def _slots(self, distinct: list[bytes]) -> np.ndarray:
        slots = self.new.find(distinct)
        missing = np.flatnonzero(slots < 0)
        if self.new.places and len(self.new.places) + len(missing) > self.most:
            self.old, self.new = self.new, _Generation()
            missing = np.arange(len(distinct))
        if len(missing):
            earlier = self.old.find([distinct[i] for i in missing])
            known = missing[earlier >= 0]
            if len(known):
                ids, bounds = gathered(self.old.first, self.old.ids, earlier[earlier >= 0])
                slots[known] = self.new.add([distinct[i] for i in known], ids, np.diff(bounds))
            fresh = missing[earlier < 0]
            if len(fresh):
                strings = [distinct[i] for i in fresh]
                slots[fresh] = self.new.add(strings, *self.make(strings))
        return slots

    def look_up(self, strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all binary strings one after the other, and the strings' offsets in them."""
        if not len(strings):
            return np.zeros(0, dtype=np.int32), np.zeros(1, dtype=np.int64)
        coded = strings.dictionary_encode()
        slots = self._slots(coded.dictionary.to_numpy(zero_copy_only=False).tolist())[coded.indices.to_numpy()]
        return gathered(self.new.first, self.new.ids, slots)
