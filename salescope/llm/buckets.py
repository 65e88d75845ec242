"""Hashed entries on their way to the partition of their hash, packed so that an entry takes a few bytes of shuffle.

A row holds the entries of one task that go to one partition: which documents they come from, how many entries each has,
their places as steps from one to the next, and part of their hashes. The partition itself stands for the rest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from salescope.llm.blocks import from_planes

SCHEMA = "bucket int, kind int, docs binary, sizes binary, places binary, hashes binary"
FLUSH = 1_500_000


def _planes(values: np.ndarray, size: int) -> bytes:
    """The lowest ``size`` bytes of numbers, byte by byte: planes of zeros compress away."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize)[:, :size].T).tobytes()


def hashes_from(data: bytes, size: int) -> np.ndarray:
    parts = np.frombuffer(data, dtype=np.uint8).reshape(size, -1)
    whole = np.zeros((parts.shape[1], 8), dtype=np.uint8)
    whole[:, :size] = parts.T
    return whole.view(np.uint64).ravel()


class Entries:
    """Entries of one kind that wait to be sent; ``size`` bytes of each hash are sent along."""

    def __init__(self, kind: int, partitions: int, size: int, smallest_only: bool = False):
        self.kind, self.partitions, self.size, self.smallest_only = kind, partitions, size, smallest_only
        self.held: list[tuple[np.ndarray, ...]] = []
        self.count = 0

    def add(self, hashes: np.ndarray, docs: np.ndarray, places: np.ndarray, routes: np.ndarray | None = None) -> None:
        """Entries in order of document and place. Entries with equal hashes have equal ``routes``, which decide on the
        partition; without, the hash itself does."""
        if len(hashes):
            route = hashes if routes is None else routes
            bucket = ((route >> np.uint64(40)) % np.uint64(self.partitions)).astype(np.uint32)
            self.held.append((hashes, docs, places, bucket))
            self.count += len(hashes)

    def rows(self, at_end: bool = False) -> Iterator[pa.RecordBatch]:
        if not self.held or (self.count < FLUSH and not at_end):
            return
        hashes, docs, places, bucket = (np.concatenate(x) for x in zip(*self.held))
        self.held, self.count = [], 0
        if self.smallest_only:
            order = np.lexsort((docs, hashes))
            hashes, docs, places, bucket = hashes[order], docs[order], places[order], bucket[order]
            first = np.ones(len(hashes), dtype=bool)
            first[1:] = hashes[1:] != hashes[:-1]
            again = np.argsort(docs[first], kind="stable")
            hashes, docs, places, bucket = (x[first][again] for x in (hashes, docs, places, bucket))
        bucket = bucket.astype(np.uint16) if self.partitions < 1 << 16 else bucket
        order = np.argsort(bucket, kind="stable")
        bucket, hashes, docs, places = bucket[order], hashes[order], docs[order], places[order]
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]))
        columns: list[list] = [[], [], [], [], [], []]
        for low, high in zip(cuts[:-1], cuts[1:]):
            own = docs[low:high]
            runs = np.concatenate(([0], np.flatnonzero(np.diff(own)) + 1))
            steps = np.diff(places[low:high], prepend=0)
            steps[runs] = places[low:high][runs]
            sizes = np.diff(np.append(runs, high - low))
            row = (
                int(bucket[low]),
                self.kind,
                _planes(own[runs], 8),
                _planes(sizes.astype(np.uint32), 4),
                b"" if self.smallest_only else _planes(steps.astype(np.int32), 4),
                _planes(hashes[low:high], self.size),
            )
            for column, value in zip(columns, row):
                column.append(value)
        kinds = (pa.int32(), pa.int32(), *[pa.binary()] * 4)
        names = ["bucket", "kind", "docs", "sizes", "places", "hashes"]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)


def dealt(packed: DataFrame, partitions: int) -> DataFrame:
    """Rows in the partition of their bucket, the kinds one after the other."""
    return packed.repartitionById(partitions, "bucket").sortWithinPartitions("kind")


def received(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(kind, hashes, documents, places) of one row after the other."""
    for batch in batches:
        for i in range(len(batch)):
            row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
            hashes = hashes_from(row["hashes"], size)
            sizes = from_planes(row["sizes"], np.uint32).astype(np.int64)
            docs = np.repeat(from_planes(row["docs"], np.int64), sizes)
            places = np.zeros(len(hashes), dtype=np.int64)
            if row["places"]:
                steps = from_planes(row["places"], np.int32).astype(np.int64)
                sums = np.cumsum(steps)
                starts = np.cumsum(sizes) - sizes
                places = sums - np.repeat(sums[starts] - steps[starts], sizes)
            yield row["kind"], hashes, docs, places


class Smallest:
    """The smallest document of every hash that was told; ``latest`` keeps the largest that was seen later."""

    def __init__(self) -> None:
        self.told: list[tuple[np.ndarray, np.ndarray]] = []
        self.hashes: np.ndarray | None = None

    def tell(self, hashes: np.ndarray, docs: np.ndarray) -> None:
        self.told.append((hashes, docs))
        if sum(len(h) for h, _ in self.told[1:]) > 1 << 20:
            self.told = [self._merged()]

    def _merged(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.told:
            return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        hashes, docs = (np.concatenate(x) for x in zip(*self.told))
        order = np.lexsort((docs, hashes))
        hashes, docs = hashes[order], docs[order]
        first = np.ones(len(hashes), dtype=bool)
        first[1:] = hashes[1:] != hashes[:-1]
        return hashes[first], docs[first]

    def close(self) -> None:
        if self.hashes is None:
            self.hashes, self.docs = self._merged()
            self.latest = np.full(len(self.docs), np.iinfo(np.int64).min)
            self.told = []
            self.marked = np.zeros(1 << 22, dtype=bool)
            self.marked[(self.hashes & np.uint64((1 << 22) - 1)).astype(np.int64)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indexes of the given hashes that were told, and their places among those told."""
        self.close()
        near = np.flatnonzero(self.marked[(hashes & np.uint64((1 << 22) - 1)).astype(np.int64)])
        slots = np.searchsorted(self.hashes, hashes[near])
        slots[slots == len(self.hashes)] = 0
        hit = self.hashes[slots] == hashes[near] if len(self.hashes) else np.zeros(len(near), dtype=bool)
        return near[hit], slots[hit]
