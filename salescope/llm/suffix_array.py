"""Removal of repeated byte strings by longest-previous-factor arrays over suffix arrays.

Every string of ``length`` bytes that a text holds more than once, or several texts hold, is found. ``keep="first"``
removes the copies after the first one (in order of ``doc_id`` and place), ``keep="none"`` all of them.

The suffix array of a whole corpus fits no machine, so strings are first brought together that can be equal:

1. Each string is represented by its smallest n-gram of ``GRAM`` bytes, the leftmost one of equals. Neighbouring strings
   mostly have the same, so a text becomes a list of anchors, each with the stretch of strings that it stands for. Equal
   strings have equal anchors, so only stretches with the same anchor have to be compared.
2. Stretches of equal bytes, one kind, are copies of each other: the first and the last place of each kind mark them. Of each kind of stretch only the first copy goes on, and only if its anchor has other kinds too.
3. The bytes of these go to the partition of their anchor. There their suffixes are sorted to the depth of ``length``
   bytes; in that order, the previous and next suffix with a smaller place are the ones that can share most bytes with a
   suffix, so the longer of the two common prefixes is its longest previous factor. From ``length`` bytes on, an earlier
   copy exists. The same with places reversed gives the longest next factor and so the copies that come later.
4. An anchor with more than ``MOST_KINDS`` kinds of stretches (a passage between ever new neighbours) is not sorted by one
   task: its strings are dealt out one by one, by their own hash, and marked as in step 2.

NULL and empty texts have no bytes. Rows without ``doc_id`` are returned as they are and are nobody's copy. Repeated rows
are copies of each other; with ``keep="first"`` they all stay as one, since nothing tells which is first. Strings never
reach from one text into another. Other columns are ignored. Stretches and single strings are compared by two 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salescope.llm.blocks import binary_column, covered, flat, per_piece, pieces, whole_runs
from salescope.sources.scratch import materialize

LENGTH = 200
GRAM = 64
MOST_KINDS = 2000
SORTED_BYTES = 1 << 19
# Name of the column of runs; no column of a table should have it.
RUNS = "__repeated_runs"
ANCHORS = "key long, kind long, doc_id long, first int, last int"


def _gram_order(data: np.ndarray, size: int) -> np.ndarray:
    """A 32-bit hash of the ``size`` bytes at every place; ``size`` is a power of two."""
    hashed = (data.astype(np.uint32) + np.uint32(1)) * np.uint32(0x9E3779B1)
    span = 1
    while span < size:
        hashed = (hashed[:-span] * np.uint32(0x85EBCA77)) ^ (hashed[span:] + (hashed[:-span] >> np.uint32(15)))
        hashed *= np.uint32(0xC2B2AE3D)
        span *= 2
    return hashed ^ (hashed >> np.uint32(15))


def _leftmost_smallest(values: np.ndarray, size: int) -> np.ndarray:
    """Place of the smallest of ``size`` neighbouring 32-bit values, the leftmost of equals."""
    least = (values.astype(np.uint64) << np.uint64(32)) | np.arange(len(values), dtype=np.uint64)
    span = 1
    while 2 * span <= size:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    rest = size - span
    least = np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
    return (least & np.uint64(0xFFFFFFFF)).astype(np.int64)


def stretches(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(text, first string, last string, anchor) of every stretch of strings with one anchor; places in ``data``."""
    starts = whole_runs(offsets, length)
    if not len(starts):
        return (np.zeros(0, dtype=np.int64),) * 4
    gram = min(GRAM, 1 << (length.bit_length() - 1))
    anchor = _leftmost_smallest(_gram_order(data, gram), length - gram + 1)[starts]
    change = np.flatnonzero((np.diff(anchor) != 0) | (np.diff(starts) != 1)) + 1
    low, high = np.concatenate(([0], change)), np.concatenate((change, [len(starts)])) - 1
    first = starts[low]
    return np.searchsorted(offsets, first, side="right") - 1, first, starts[high], anchor[low]


def _anchors(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    gram = min(GRAM, 1 << (length.bit_length() - 1))

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = flat(piece.column("text"))
        text, first, last, anchor = stretches(data, offsets, length)
        view, digest = memoryview(data), xxhash.xxh3_64_intdigest
        keys = np.array([digest(view[a : a + gram]) for a in anchor.tolist()], dtype=np.uint64)
        kinds = [digest(view[f : e + length], 1) for f, e in zip(first.tolist(), last.tolist())]
        columns = [
            pa.array(keys.view(np.int64)),
            pa.array(np.array(kinds, dtype=np.uint64).view(np.int64)),
            piece.column("doc_id").take(pa.array(text)),
            pa.array((first - offsets[text]).astype(np.int32)),
            pa.array((last - offsets[text]).astype(np.int32)),
        ]
        return pa.RecordBatch.from_arrays(columns, ["key", "kind", "doc_id", "first", "last"])

    return per_piece(work)


def _copies(anchors: DataFrame) -> DataFrame:
    """Stretches with whether an equal one comes earlier, whether one comes later, and the kinds of their anchor.

    First and last places of each kind are gathered before the shuffle, kinds of an anchor are counted from one row per kind,
    and the stretches meet their kind in a join, which splits a kind with very many copies; so nothing gathers all stretches
    of an anchor or of a kind. Repeated rows are copies of each other, none of them earlier.
    """
    place = F.struct("doc_id", "first")
    kinds = anchors.groupBy("key", "kind").agg(F.min(place).alias("low"), F.max(place).alias("high"), F.count(F.lit(1)).alias("n"))
    kinds = materialize(kinds, "kinds_of_stretches")
    several = kinds.groupBy("key").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    known = kinds.join(several, "key", "left").where("n > 1 or kinds > 1").withColumn("kinds", F.coalesce("kinds", F.lit(1).cast("long")))
    marked = anchors.join(known, ["key", "kind"])
    return marked.select(
        *anchors.columns, (place > F.col("low")).alias("earlier"), ((place < F.col("high")) | ((F.col("n") > 1) & (F.col("low") == F.col("high")))).alias("later"), "kinds"
    )


def _bytes(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The bytes of wanted stretches; of crowded ones the single strings instead, as anchors of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text", 1 << 19):
                data, offsets = flat(piece.column("text"))
                view = memoryview(data)
                rows = []
                for i, (doc_id, wanted) in enumerate(zip(piece.column("doc_id").to_pylist(), piece.column("wanted").to_pylist())):
                    base = int(offsets[i])
                    for item in wanted:
                        first, last = item["first"], item["last"]
                        if last + length > offsets[i + 1] - base:
                            continue  # of another row with the same id
                        if not item["crowded"]:
                            rows.append((item["key"], 0, doc_id, first, last, bytes(view[base + first : base + last + length])))
                            continue
                        for place in range(first, last + 1):
                            string = view[base + place : base + place + length]
                            key, kind = (xxhash.xxh3_64_intdigest(string, seed) - (1 << 63) for seed in (0, 1))
                            rows.append((key, kind, doc_id, place, place, None))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
                columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(columns, ["key", "kind", "doc_id", "first", "last", "bytes"])

    return run


def suffix_order(data: np.ndarray, starts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes at ``starts`` by their first ``depth`` bytes, and the common prefix of each with the one
    before it, at most ``depth``."""
    rows = np.lib.stride_tricks.sliding_window_view(data, depth)[starts]
    order = np.argsort(rows.view(f"S{depth}").ravel(), kind="stable")
    rows = rows[order]
    differ = rows[1:] != rows[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), depth)
    return order, np.concatenate(([0], common))


def _nearest_smaller(places: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Common prefix of each suffix with the nearest one before it, in suffix order, that has a smaller place.

    All suffixes jump at the same time: where the candidate has a larger place, its own candidate is next, since all
    between the two have larger places still.
    """
    candidate = np.arange(-1, len(places) - 1)
    shared = common.copy()
    moving = np.arange(len(places))
    while True:
        moving = moving[candidate[moving] >= 0]
        moving = moving[places[candidate[moving]] > places[moving]]
        if not len(moving):
            break
        via = candidate[moving]
        shared[moving], candidate[moving] = np.minimum(shared[moving], shared[via]), candidate[via]
    return np.where(candidate >= 0, shared, 0)


def longest_previous_factors(places: np.ndarray, common: np.ndarray) -> np.ndarray:
    """For suffixes in suffix order: the longest prefix that a suffix with a smaller place has too."""
    back = np.concatenate((common[1:], [0]))[::-1]
    previous, following = _nearest_smaller(places, common), _nearest_smaller(places[::-1], np.concatenate(([0], back[1:])))[::-1]
    return np.maximum(previous, following)


def _factors(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Strings with a copy in another stretch of their anchor, as runs (doc_id, first, last, earlier)."""

    def found(rows: list[dict]) -> Iterator[pa.RecordBatch]:
        data, offsets = flat(pa.array([r["bytes"] for r in rows], pa.binary()))
        starts = whole_runs(offsets, length)
        owner = np.searchsorted(offsets, starts, side="right") - 1
        docs = np.array([r["doc_id"] for r in rows], dtype=np.int64)[owner]
        place = np.array([r["first"] for r in rows], dtype=np.int64)[owner] + starts - offsets[owner]
        rank = np.empty(len(starts), dtype=np.int64)
        rank[np.lexsort((place, docs))] = np.arange(len(starts))
        order, common = suffix_order(data, starts, length)
        earlier, later = np.zeros(len(starts), dtype=bool), np.zeros(len(starts), dtype=bool)
        earlier[order] = longest_previous_factors(rank[order], common) >= length
        later[order] = longest_previous_factors(-rank[order], common) >= length
        for marked, is_later_copy in ((earlier, True), (later & ~earlier, False)):
            which = np.flatnonzero(marked)
            if len(which):
                cut = np.flatnonzero((np.diff(starts[which]) != 1) | (np.diff(owner[which]) != 0)) + 1
                low, high = which[np.concatenate(([0], cut))], which[np.concatenate((cut, [len(which)])) - 1]
                columns = [pa.array(docs[low]), pa.array(place[low], pa.int32()), pa.array(place[high], pa.int32())]
                columns.append(pa.array(np.full(len(low), is_later_copy)))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "first", "last", "earlier"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, key, seen = [], 0, None, None
        for batch in batches:
            for row in batch.to_pylist():
                if (row["key"], row["doc_id"], row["first"]) == seen:
                    continue  # of a repeated row
                if size >= SORTED_BYTES and row["key"] != key:
                    yield from found(held)
                    held, size = [], 0
                held.append(row)
                size, key, seen = size + len(row["bytes"]), row["key"], (row["key"], row["doc_id"], row["first"])
        if held:
            yield from found(held)

    return run


def repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, first, last, earlier): runs of places in the bytes of ``docs`` (doc_id, text) where a string begins that
    also begins elsewhere; ``earlier`` if one of its copies comes before."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = texts.where("doc_id is not null")
    anchors = materialize(known.mapInArrow(_anchors(length), ANCHORS), "anchors")
    marked = materialize(_copies(anchors), "stretches")
    whole = marked.where("earlier or later").select("doc_id", "first", "last", "earlier")
    wanted = marked.where("kinds > 1 and not earlier").groupBy("doc_id").agg(
        F.collect_set(F.struct("key", "first", "last", (F.col("kinds") > MOST_KINDS).alias("crowded"))).alias("wanted")
    )
    cut = materialize(known.join(wanted, "doc_id").mapInArrow(_bytes(length), f"{ANCHORS}, bytes binary"), "kinds")
    single = _copies(cut.where("bytes is null").drop("bytes")).where("earlier or later").select("doc_id", "first", "last", "earlier")
    together = cut.where("bytes is not null").repartition("key").sortWithinPartitions("key", "doc_id", "first")
    sorted_ = together.mapInArrow(_factors(length), "doc_id long, first int, last int, earlier boolean")
    return whole.unionByName(single).unionByName(sorted_)


class _Kept:
    """Texts without the strings in the column of runs."""

    def __init__(self, piece: pa.RecordBatch, runs: str, length: int, whole_characters: bool):
        data, self.offsets = flat(piece.column("text"))
        lists = piece.column(runs)
        found = lists.flatten()
        sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        owner = np.repeat(np.arange(len(piece)), sizes)
        first, last = (found.field(name).to_numpy().astype(np.int64) for name in ("first", "last"))
        inside = last + length <= np.diff(self.offsets)[owner]
        gone = covered((self.offsets[owner] + first)[inside], (last - first + length)[inside], len(data))
        if whole_characters and len(data):
            character = np.cumsum((data & 0xC0) != 0x80) - 1
            gone = ~(np.bincount(character, weights=~gone) > 0)[character]
        self.removed = np.concatenate(([0], np.cumsum(gone)))[self.offsets]
        begins = gone.copy()
        begins[1:] &= ~gone[:-1]
        edges = self.offsets[:-1][self.offsets[:-1] < len(data)]
        begins[edges] |= gone[edges]
        self.spans = np.concatenate(([0], np.cumsum(begins)))[self.offsets]
        self.text = binary_column(data[~gone], self.offsets - self.removed, pa.string() if whole_characters else pa.binary())


def _figures(length: int, whole_characters: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        kept = _Kept(piece, RUNS, length, whole_characters)
        counts = [pa.array(np.diff(x), pa.int64()) for x in (kept.offsets, kept.removed, kept.spans)]
        return pa.RecordBatch.from_arrays(
            [piece.column("doc_id"), *counts, kept.text], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
        )

    return per_piece(work)


def _with_runs(docs: DataFrame, length: int, keep: str) -> DataFrame:
    """``docs`` with the runs of places to remove."""
    if keep not in ("first", "none"):
        raise ValueError("keep is 'first' or 'none'")
    found = repeats(docs, length)
    gone = found.where("earlier") if keep == "first" else found
    gone = materialize(gone.select("doc_id", "first", "last"), "repeats")
    runs = gone.groupBy(F.col("doc_id").alias(RUNS + "_id")).agg(F.collect_list(F.struct("first", "last")).alias(RUNS))
    return docs.join(runs, F.col("doc_id") == F.col(RUNS + "_id"), "left").drop(RUNS + "_id")


def deduplicate(docs: DataFrame, length: int = LENGTH, keep: str = "first", whole_characters: bool = True) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) for every row of ``docs``; ``n_spans`` counts the runs of removed bytes.

    With ``whole_characters`` a character stays unless all its bytes go, and ``kept`` is text; without, it is binary.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = f"doc_id long, n_bytes long, n_removed long, n_spans long, kept {'string' if whole_characters else 'binary'}"
    return _with_runs(texts, length, keep).mapInArrow(_figures(length, whole_characters), schema)


def remove(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The rows of ``docs`` with all their columns, texts without the copies after the first; NULL texts become empty."""

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        text = _Kept(piece, RUNS, length, True).text
        return pa.RecordBatch.from_arrays([text if n == "text" else piece.column(n) for n in names], names)

    names = docs.columns
    return _with_runs(docs, length, "first").mapInArrow(per_piece(work), docs.schema)
