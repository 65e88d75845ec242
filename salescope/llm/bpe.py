"""Byte-level BPE: every text is cut by a pattern, and each cut is merged pair by pair in the order of the ranks.

Merging uses a segment tree over the byte places of a cut. A leaf holds the rank of the pair that starts there, an
inner node the smallest key ``rank * 2**32 + place`` below it, so the root names the leftmost pair of the smallest rank.
A merge changes three leaves: the pair is gone, the pair that starts at its left end is new, and so is the one that
ends there. Each change walks up one path, so a cut of n bytes takes O(n log n) steps, also one of a million letters.

Many cuts are merged at the same time: cuts of similar length share one array of trees, and each step performs one
merge in each of them. Cuts repeat, so each distinct one of a piece is merged once, and a bounded store keeps the
results for the next pieces of the task.

NULL and empty texts have no ids. Equal texts have equal ids; columns other than the id and the text are ignored. Bytes
are those of UTF-8, so decoding the ids always gives the text back.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.llm.blocks import binary_column, flat, per_piece
from salescope.llm.idstore import IdStore

NO_PAIR = np.int64(1 << 62)
# Ids as text, for digests.
DECIMAL = [str(i) for i in range(1 << 16)]
PIECE_BYTES = 1 << 20


class Vocabulary:
    """Ranks of byte strings, and for every pair of ids the id of both together."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern, self.ranks = regex.compile(pattern), ranks
        self.tokens: dict[int, bytes] = {rank: token for token, rank in ranks.items()}
        self.bytes_to_id = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        left, right, both = [], [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), both.append(rank)
        self._index(np.array(left, dtype=np.int64), np.array(right, dtype=np.int64), np.array(both, dtype=np.int64))
        self.store = IdStore(self.merge)

    def _index(self, left: np.ndarray, right: np.ndarray, both: np.ndarray) -> None:
        """Open addressing in arrays, so that a whole array of pairs is looked up at once."""
        self.bits = max(4, int(len(left) * 4 - 1).bit_length())
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.values = np.full(1 << self.bits, NO_PAIR, dtype=np.int64)
        keys = (left << 32) | right
        slots, waiting, self.probes = self._slot(keys), np.arange(len(keys)), 0
        while len(waiting):
            self.probes += 1
            free = waiting[self.keys[slots[waiting]] == -1]
            chosen, first = np.unique(slots[free], return_index=True)
            self.keys[chosen], self.values[chosen] = keys[free[first]], both[free[first]]
            done = np.zeros(len(keys), dtype=bool)
            done[free[first]] = True
            waiting = waiting[~done[waiting]]
            slots[waiting] = (slots[waiting] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        spread = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (spread >> np.uint64(64 - self.bits)).astype(np.int64)

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the two ids together; NO_PAIR where there is none."""
        keys = (left << 32) | right
        slots = self._slot(keys)
        found = np.where(self.keys[slots] == keys, self.values[slots], NO_PAIR)
        open_ = np.flatnonzero((self.keys[slots] != keys) & (self.keys[slots] != -1))
        for _ in range(self.probes):
            if not len(open_):
                break
            slots[open_] = (slots[open_] + 1) & ((1 << self.bits) - 1)
            held = self.keys[slots[open_]]
            hit = held == keys[open_]
            found[open_[hit]] = self.values[slots[open_[hit]]]
            open_ = open_[~hit & (held != -1)]
        return found

    def merge(self, cuts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all cuts one after the other, and how many each has."""
        counts = np.ones(len(cuts), dtype=np.int64)
        classes: dict[int, list[int]] = {}
        found: list[tuple[np.ndarray, np.ndarray]] = []
        whole: list[tuple[int, int]] = []
        for i, cut in enumerate(cuts):
            rank = self.ranks.get(cut)
            if rank is None:
                classes.setdefault((len(cut) - 1).bit_length(), []).append(i)
            else:
                whole.append((i, rank))
        if whole:
            known = np.array(whole, dtype=np.int64)
            found.append((known[:, 0], known[:, 1]))
        for depth, members in classes.items():
            together = max(1, (1 << 20) >> depth)
            for at in range(0, len(members), together):
                part = np.array(members[at : at + together], dtype=np.int64)
                ids, sizes = self._merge_trees([cuts[i] for i in part], depth)
                counts[part] = sizes
                found.append((np.repeat(part, sizes), ids))
        if not found:
            return np.zeros(0, dtype=np.int32), counts
        owners = np.concatenate([x[0] for x in found])
        order = np.argsort(owners, kind="stable")
        return np.concatenate([x[1] for x in found])[order].astype(np.int32), counts

    def _merge_trees(self, cuts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of cuts of at most 2**depth bytes, one tree for each, and how many each cut has."""
        width, n = 1 << depth, len(cuts)
        sizes = np.array([len(c) for c in cuts], dtype=np.int64)
        places = np.arange(width)
        inside = places < sizes[:, None]
        ids = np.full((n, width), -1, dtype=np.int64)
        ids[inside] = self.bytes_to_id[np.frombuffer(b"".join(cuts), dtype=np.uint8)]
        after = np.where(places + 1 < sizes[:, None], places + 1, width).ravel()
        before = np.tile(places - 1, n)
        tree = np.full((n, 2 * width), NO_PAIR, dtype=np.int64)
        starts = np.flatnonzero(places + 1 < sizes[:, None])
        ids = ids.ravel()
        leaves = np.full(n * width, NO_PAIR, dtype=np.int64)
        leaves[starts] = self._keys(ids[starts], ids[starts + 1], starts % width)
        tree[:, width:] = leaves.reshape(n, width)
        for level in range(depth - 1, -1, -1):
            first = 1 << level
            tree[:, first : 2 * first] = np.minimum(tree[:, 2 * first : 4 * first : 2], tree[:, 2 * first + 1 : 4 * first : 2])
        tree = tree.ravel()
        rows = np.arange(n)
        while True:
            root = tree[rows * (2 * width) + 1]
            rows, root = rows[root < NO_PAIR], root[root < NO_PAIR]
            if not len(rows):
                break
            place, rank = root & 0xFFFFFFFF, root >> 32
            base, top = rows * width, rows * (2 * width)
            gone = after[base + place]
            follower = after[base + gone]
            ids[base + place], ids[base + gone] = rank, -1
            after[base + place] = follower
            linked = np.flatnonzero(follower < width)
            before[base[linked] + follower[linked]] = place[linked]
            keys = np.full(len(rows), NO_PAIR, dtype=np.int64)
            keys[linked] = self._keys(rank[linked], ids[base[linked] + follower[linked]], place[linked])
            tree[top + width + gone] = NO_PAIR
            tree[top + width + place] = keys
            leader = before[base + place]
            led = np.flatnonzero(leader >= 0)
            heads = leader[led]
            tree[top[led] + width + heads] = self._keys(ids[base[led] + heads], rank[led], heads)
            tops = np.concatenate((top, top, top[led]))
            nodes = np.concatenate((gone, place, heads)) + width
            for _ in range(depth):
                nodes >>= 1
                children = tops + 2 * nodes
                tree[tops + nodes] = np.minimum(tree[children], tree[children + 1])
        kept = ids >= 0
        return ids[kept], kept.reshape(n, width).sum(axis=1)

    def _keys(self, left: np.ndarray, right: np.ndarray, places: np.ndarray) -> np.ndarray:
        ranks = self.pair(left, right)
        return np.where(ranks < NO_PAIR, (ranks << 32) | places, NO_PAIR)

    def encode(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the texts' offsets in them."""
        cuts: list[str] = []
        ends = [0]
        for text in texts:
            cuts += self.pattern.findall(text or "")
            ends.append(len(cuts))
        ids, bounds = self.store.look_up(pa.array(cuts, pa.string()).cast(pa.binary()))
        return ids, bounds[ends]

    def decode(self, ids: Sequence[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@lru_cache(maxsize=4)
def vocabulary(path: str, pattern: str) -> Vocabulary:
    """Read a rank file once per worker."""
    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return Vocabulary(ranks, pattern)


Step = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _encoder(path: str, pattern: str) -> Step:
    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        ids, bounds = vocabulary(path, pattern).encode(piece.column("text").to_pylist())
        lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))
        return pa.RecordBatch.from_arrays([piece.column("doc_id"), lists], ["doc_id", "ids"])

    return per_piece(work, most=PIECE_BYTES)


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids array<int>) for every row of ``docs`` (doc_id, text), without special tokens."""
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return texts.mapInArrow(_encoder(path, pattern), "doc_id long, ids array<int>")


def _decoder(path: str, pattern: str) -> Step:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(path, pattern)
        data, starts = flat(pa.array([known.tokens.get(i) for i in range(max(known.tokens) + 1)], pa.large_binary()))
        sizes = np.diff(starts)
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                column = part.column("ids")
                ids = column.flatten().to_numpy()
                bounds = np.concatenate(([0], np.cumsum(column.value_lengths().fill_null(0).to_numpy())))
                ends = np.concatenate(([0], np.cumsum(sizes[ids])))
                bytes_ = data[np.repeat(starts[ids] - ends[:-1], sizes[ids]) + np.arange(ends[-1])]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), column, binary_column(bytes_, ends[bounds])], ["doc_id", "ids", "data"]
                )

    return run


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids, data binary): the bytes that the ids stand for."""
    return encoded.select("doc_id", "ids").mapInArrow(_decoder(path, pattern), "doc_id long, ids array<int>, data binary")


def _digester(with_ids: bool) -> Step:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids").flatten().to_numpy().tolist()
            bounds = np.concatenate(([0], np.cumsum(batch.column("ids").value_lengths())))
            listed, of_ids, of_data = list(map(DECIMAL.__getitem__, ids)), [], []
            for low, high, data in zip(bounds[:-1].tolist(), bounds[1:].tolist(), batch.column("data")):
                of_ids.append(hashlib.sha256(",".join(listed[low:high]).encode()).hexdigest())
                of_data.append(hashlib.sha256(data.as_buffer()).hexdigest())
            columns = [batch.column("doc_id"), pa.array(np.diff(bounds), pa.int64()), pa.array(of_ids), pa.array(of_data)]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns, names = [*columns, batch.column("ids")], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def round_trip(docs: DataFrame, path: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """Per document: number of ids, digest of the decimal ids joined by commas and of the decoded bytes, and the ids.

    Texts are encoded, decoded and digested piece by piece in one worker, so a task needs the memory of one.
    """
    steps = _encoder(path, pattern), _decoder(path, pattern), _digester(with_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps:
            batches = step(batches)
        return batches

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return texts.mapInArrow(run, schema + (", ids array<int>" if with_ids else ""))
