"""Removal of repeated passages of words by fixed-block anchors.

A passage is ``window`` words. Every document is a reference: its non-overlapping blocks of ``window // 2`` words are
indexed. Any passage of it holds a whole block, so another document with that passage has the block at some place: all
rolling windows of a block's length are probed against the index. A hit leaves the passages around it, in the document
probed and in the reference; each hit is extended to the maximal exact repeat by comparing these passages window by
window, and a passage is a repeat if a document with a smaller id has it too. All words of such passages go.

Spark deals blocks and probes to partitions by their hash, and passages by the smallest hash of a block within them, so
that neighbouring passages mostly stay together; all are packed to a few bytes each. A partition first reads
the index entries, one for each distinct hash, and then passes the probes by, so a passage that a third of all documents
share takes no more memory than any other. Words are compared by 64-bit hashes of the whole passage.

Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. NULL and empty texts have none. Rows without ``doc_id`` are returned as
they are and are nobody's reference. Repeated rows of a document have the same id, so none is earlier than the other.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.llm.blocks import Words, binary_column, covered, flat, per_piece, pieces, ranges, run_hashes, smallest_within
from salescope.llm.buckets import SCHEMA, Entries, Smallest, dealt, received
from salescope.sources.scratch import materialize

WINDOW = 50
INDEXED, PROBED, REFERENCES = 0, 1, 2
BLOCK_HASH_BYTES, WINDOW_HASH_BYTES = 5, 8


def _probes(window: int, partitions: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Blocks and rolling windows of documents that are long enough for a passage."""
    block = window // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Entries(INDEXED, partitions, BLOCK_HASH_BYTES, smallest_only=True)
        probes = Entries(PROBED, partitions, BLOCK_HASH_BYTES)
        references = Entries(REFERENCES, partitions, BLOCK_HASH_BYTES)
        for batch in batches:
            for piece in pieces(batch, "text"):
                words = Words(*flat(piece.column("text")))
                ids = piece.column("doc_id").to_numpy()
                counts = np.where(words.counts >= window, words.counts - block + 1, 0)
                starts = ranges(words.bounds[:-1], counts)
                if not len(starts):
                    continue
                hashes = run_hashes(words.hashes(), block)[starts]
                docs = np.repeat(ids, counts)
                places = starts - np.repeat(words.bounds[:-1], counts)
                own = places % block == 0
                index.add(hashes[own], docs[own], places[own])
                references.add(hashes[own], docs[own], places[own])
                probes.add(hashes, docs, places)
                for entries in (index, probes, references):
                    yield from entries.rows()
        for entries in (index, probes, references):
            yield from entries.rows(at_end=True)

    return run


def _hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places of blocks that a document shares with an earlier one (kind PROBED) or a later one (kind REFERENCES)."""
    smallest = Smallest()
    for kind, hashes, docs, places in received(batches, BLOCK_HASH_BYTES):
        if kind == INDEXED:
            smallest.tell(hashes, docs)
            continue
        found, slots = smallest.find(hashes)
        if kind == PROBED:
            np.maximum.at(smallest.latest, slots, docs[found])
            found = found[docs[found] > smallest.docs[slots]]
        else:
            found = found[docs[found] < smallest.latest[slots]]
        columns = [pa.array(docs[found]), pa.array(np.full(len(found), kind), pa.int32()), pa.array(places[found], pa.int32())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "kind", "place"])


def _passages(window: int, partitions: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The passages around the hits, those of references and those of probed documents."""
    block = window // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        references = Entries(INDEXED, partitions, WINDOW_HASH_BYTES, smallest_only=True)
        probes = Entries(PROBED, partitions, WINDOW_HASH_BYTES)
        for batch in batches:
            for piece in pieces(batch, "text"):
                words = Words(*flat(piece.column("text")))
                single = words.hashes()
                hashes, routes = run_hashes(single, window), smallest_within(run_hashes(single, block), window - block + 1)
                ids = piece.column("doc_id").to_numpy()
                for entries, name in ((references, "shared"), (probes, "probed")):
                    lists = piece.column(name)
                    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                    owner = np.repeat(np.arange(len(ids)), sizes)
                    hit = lists.flatten().to_numpy().astype(np.int64)
                    low = np.maximum(hit - (window - block), 0)
                    high = np.minimum(hit, words.counts[owner] - window)
                    good = high >= low
                    wanted = covered(words.bounds[:-1][owner[good]] + low[good], (high - low + 1)[good], len(hashes) + window)
                    starts = np.flatnonzero(wanted[: len(hashes)])
                    text = np.searchsorted(words.bounds, starts, side="right") - 1
                    entries.add(hashes[starts], ids[text], starts - words.bounds[text], routes[starts])
                    yield from entries.rows()
        for entries in (references, probes):
            yield from entries.rows(at_end=True)

    return run


def _repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of starts of passages that an earlier document has."""
    smallest = Smallest()
    for kind, hashes, docs, places in received(batches, WINDOW_HASH_BYTES):
        if kind == INDEXED:
            smallest.tell(hashes, docs)
            continue
        found, slots = smallest.find(hashes)
        found = found[docs[found] > smallest.docs[slots]]
        if len(found):
            docs, places = docs[found], places[found]
            cut = np.flatnonzero((np.diff(docs) != 0) | (np.diff(places) != 1)) + 1
            low, high = np.concatenate(([0], cut)), np.concatenate((cut, [len(docs)])) - 1
            columns = [pa.array(docs[low]), pa.array(places[low], pa.int32()), pa.array(places[high], pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "first", "last"])


def _kept(window: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        words = Words(*flat(piece.column("text")))
        lists = piece.column("runs")
        sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        owner = np.repeat(np.arange(len(piece)), sizes)
        first, last = (lists.flatten().field(name).to_numpy().astype(np.int64) for name in ("first", "last"))
        total = len(words.starts)
        gone = covered(words.bounds[:-1][owner] + first, last - first + window, total + window)[:total]
        left = np.concatenate(([0], np.cumsum(~gone)))[words.bounds]
        # Each kept word with one space before it; the space before a text's first word is cut off.
        start, end = words.starts[~gone], words.ends[~gone]
        lengths = end - start + 1
        ends = np.concatenate(([0], np.cumsum(lengths)))
        data = np.full(ends[-1], 32, dtype=np.uint8)
        inside = ranges(ends[:-1] + 1, lengths - 1)
        data[inside] = words.data[ranges(start, lengths - 1)]
        first = np.ones(len(data), dtype=bool)
        first[ends[:-1][left[:-1][left[1:] > left[:-1]]]] = False
        offsets = ends[left] - np.concatenate(([0], np.cumsum(left[1:] > left[:-1])))
        counts = words.counts
        return pa.RecordBatch.from_arrays(
            [
                piece.column("doc_id"),
                pa.array(counts, pa.int64()),
                pa.array(counts - np.diff(left), pa.int64()),
                binary_column(data[first], offsets, pa.string()),
            ],
            ["doc_id", "n_words", "n_removed", "kept"],
        )

    return per_piece(work)


def deduplicate(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) for every row of ``docs`` (doc_id, text); ``kept`` joins words by one space."""
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = texts.where("doc_id is not null")
    probes = dealt(known.mapInArrow(_probes(window, partitions), SCHEMA), partitions)
    hits = materialize(probes.mapInArrow(_hits, "doc_id long, kind int, place int"), "anchors")
    around = hits.groupBy("doc_id").agg(
        F.collect_list(F.when(F.col("kind") == REFERENCES, F.col("place"))).alias("shared"),
        F.collect_list(F.when(F.col("kind") == PROBED, F.col("place"))).alias("probed"),
    )
    passages = dealt(known.join(around, "doc_id").mapInArrow(_passages(window, partitions), SCHEMA), partitions)
    repeats = materialize(passages.mapInArrow(_repeats, "doc_id long, first int, last int"), "repeats")
    found = repeats.groupBy("doc_id").agg(F.collect_list(F.struct("first", "last")).alias("runs"))
    return texts.join(found, "doc_id", "left").mapInArrow(
        _kept(window), "doc_id long, n_words long, n_removed long, kept string"
    )
