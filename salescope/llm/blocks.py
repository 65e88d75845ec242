"""Text columns as flat arrays inside one task: bounded pieces, words, and hashes of runs of values.

Everything here is a small vectorised helper for one piece of a partition; Spark deals out the pieces.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

PIECE_BYTES = 1 << 20
# Words up to this many bytes are hashed by table; longer ones one at a time.
TABLE_BYTES = 24


@lru_cache(maxsize=1)
def _libc() -> ctypes.CDLL | None:
    try:
        return ctypes.CDLL("libc.so.6")
    except OSError:  # another C library gives memory back by itself
        return None


def release() -> None:
    """Give freed memory back to the machine: Spark keeps Python workers for the next tasks, and others need it now."""
    pa.default_memory_pool().release_unused()
    if _libc() is not None:
        _libc().malloc_trim(0)


def pieces(batch: pa.RecordBatch, column: str, most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most ``most`` bytes in a column, or one row if that row is larger."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes.astype(np.int64))
    row = 0
    while row < len(batch):
        before = ends[row - 1] if row else 0
        stop = max(row + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(row, stop - row)
        row = stop
    release()


def per_piece(
    work: Callable[[pa.RecordBatch], pa.RecordBatch | None], column: str = "text", most: int = PIECE_BYTES
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for ``mapInArrow`` that hands ``work`` one bounded piece after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, column, most):
                made = work(piece)
                if made is not None and len(made):
                    yield made

    return run


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all values one after the other, and the offsets of the values; NULL counts as empty."""
    filled = pc.fill_null(column, "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    values = filled.cast(pa.large_binary())
    _, offsets, data = values.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[values.offset : values.offset + len(values) + 1]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return whole[bounds[0] : bounds[-1]], bounds - bounds[0]


def binary_column(data: np.ndarray, offsets: np.ndarray, kind: pa.DataType = pa.binary()) -> pa.Array:
    """A binary or string column over flat bytes."""
    bounds = np.ascontiguousarray(offsets, dtype=np.int32)
    return pa.Array.from_buffers(kind, len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))])


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z, every other byte as it is."""
    capital = (data >= 65) & (data <= 90)
    return data + capital.astype(np.uint8) * np.uint8(32)


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of flat texts: byte ranges, and the range of words of each text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray | None = None):
        """``breaks``: places at which a word ends and the next one begins, besides white space."""
        inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[offsets] = True
        if breaks is not None:
            edge[breaks] = True
        before = np.zeros(len(data), dtype=bool)
        before[1:] = inside[:-1]
        after = np.zeros(len(data), dtype=bool)
        after[:-1] = inside[1:]
        self.starts = np.flatnonzero(inside & (~before | edge[:-1]))
        self.ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        self.data, self.offsets = data, offsets
        self.bounds = np.searchsorted(self.starts, offsets)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def texts(self) -> np.ndarray:
        """Index of the text that each word belongs to."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def packed(self) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of the words without what lies between, and the words' offsets in them."""
        sizes = self.ends - self.starts
        offsets = np.zeros(len(sizes) + 1, dtype=np.int64)
        np.cumsum(sizes, out=offsets[1:])
        data = self.data
        return data[~((data == 32) | ((data >= 9) & (data <= 13)))], offsets

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        data, offsets = self.packed()
        return byte_hashes(data, offsets)


def _table() -> np.ndarray:
    return np.random.default_rng(20240611).integers(1, 1 << 63, size=(TABLE_BYTES, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


TABLE = _table()


def byte_hashes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Tabulation hash of byte strings that lie one after the other: a random number for every (place, byte)."""
    sizes = np.diff(offsets)
    if not len(sizes):
        return np.zeros(0, dtype=np.uint64)
    place = np.arange(len(data), dtype=np.int64) - np.repeat(offsets[:-1], sizes)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(TABLE.ravel()[(np.minimum(place, TABLE_BYTES - 1) << 8) | data], out=sums[1:])
    found = sums[offsets[1:]] - sums[offsets[:-1]]
    for i in np.flatnonzero(sizes > TABLE_BYTES):
        found[i] = xxhash.xxh3_64_intdigest(data[offsets[i] : offsets[i + 1]].tobytes())
    return mixed(found)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of two neighbours, in this order."""
    x = left * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x += right
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def run_hashes(values: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` neighbouring values, from hashes of runs of 1, 2, 4, ... values."""
    count = len(values) - size + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    result, covered, power, span, left = None, 0, values, 1, size
    while left:
        if left & 1:
            part = power[covered : covered + count]
            result = part if result is None else joined(result, part)
            covered += span
        left >>= 1
        if left:
            power = joined(power[:-span], power[span:])
            span *= 2
    return result


def smallest_within(values: np.ndarray, size: int) -> np.ndarray:
    """Smallest of every ``size`` neighbouring values."""
    if len(values) < size:
        return values[:0]
    least, span = values, 1
    while 2 * span <= size:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    rest = size - span
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


def whole_runs(bounds: np.ndarray, size: int) -> np.ndarray:
    """Starts of the runs of ``size`` values that stay inside one text; texts are ranges in ``bounds``."""
    counts = np.maximum(np.diff(bounds) - size + 1, 0)
    return ranges(bounds[:-1], counts)


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for every range, one after the other."""
    total = int(counts.sum())
    shift = np.repeat(starts - (np.cumsum(counts) - counts), counts)
    return np.arange(total, dtype=np.int64) + shift


def covered(starts: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """True where a place lies in one of the ranges."""
    steps = np.zeros(size + 1, dtype=np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + counts, -1)
    return np.cumsum(steps[:-1]) > 0


def spans(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    steps = np.diff(np.concatenate(([False], mask, [False])).astype(np.int8))
    return np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)


def planes(values: np.ndarray) -> bytes:
    """The bytes of numbers, first all lowest bytes, then all second bytes, ...: zero planes compress away."""
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def from_planes(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(size, -1).T).view(kind).ravel()
