"""Near-duplicate documents by HyperMinHash sketches, with every link confirmed on the full shingle sets.

A document is the set of its distinct shingles of ``words`` words (A-Z in lower case). Shingles are dealt to
``REGISTERS`` bins by their hash; a bin keeps the smallest of a second hash as its count of leading zeros and the next
``MANTISSA`` bits. An empty bin borrows from the filled bin that comes first in the bin's own fixed random order, so that
small sets fill all bins and similar sets borrow alike. ``BANDS`` bands of ``ROWS`` registers are hashed; documents that
share a band meet in a bucket. At a similarity of 0.8 a pair misses all bands once in ten million cases.

1. Documents with equal sets are linked at once; only the smallest id of each set goes on.
2. In every bucket each member is paired with one centre. Pairs whose sizes or registers rule the similarity out are
   dropped: the share of equal registers is corrected for registers that are equal by chance, and the margin below the
   threshold is five standard errors. The rest is confirmed on the full sets, and components are formed.
3. Buckets that still hold members of different components are compared member by member, block against block: first
   by registers, then by the ``LEAST`` smallest shingles of both. Sets of up to that size are compared whole, so only true
   links of theirs go on to be confirmed; of larger sets those go on that are within five standard errors.

So a large group of copies costs one pair for each member and not for each two, and a large group of texts that are
almost similar enough is told apart without a row for each two of them. Centres with very many members are split among
tasks; a confirming task holds one set and passes the others by.

A text with fewer words has its whole sequence as its one shingle. Texts that are NULL, empty or white space have no set
and are linked with nothing. Rows without ``doc_id`` are linked with nothing and kept. Repeated rows of a document have
equal sets. Other columns are ignored. Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescope.llm.blocks import Words, flat, joined, lowered, mixed, per_piece, run_hashes, whole_runs
from salescope.llm.components import components
from salescope.sources.scratch import materialize

REGISTERS, BANDS, ROWS, MANTISSA = 200, 40, 5, 10
THRESHOLD = 80
BLOCK = 512
LEAST = 512
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_sets(column: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, in ascending order within each text, and the texts' offsets in them."""
    data, offsets = flat(column)
    found = Words(lowered(data), offsets)
    hashes, counts = found.hashes(), found.counts
    starts = whole_runs(found.bounds, words)
    shingles = run_hashes(hashes, words)[starts] if len(starts) else np.zeros(0, dtype=np.uint64)
    ends = np.cumsum(np.maximum(counts - words + 1, 0))
    sets = []
    for i, count in enumerate(counts.tolist()):
        if count >= words:
            sets.append(np.unique(shingles[ends[i] - (count - words + 1) : ends[i]]))
        elif count:
            whole = run_hashes(hashes[found.bounds[i] : found.bounds[i + 1]], count)
            sets.append(mixed(whole + np.uint64(count)))
        else:
            sets.append(shingles[:0])
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    return np.concatenate([*sets, shingles[:0]]), np.concatenate(([0], np.cumsum(sizes)))


@lru_cache(maxsize=1)
def _borrowing() -> np.ndarray:
    """For every bin the fixed random order in which it asks the others."""
    return np.random.default_rng(7).permuted(np.tile(np.arange(REGISTERS, dtype=np.uint16), (REGISTERS, 1)), axis=1)


def sketch(shingles: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Registers of every set, 16 bits each; an empty set has none filled."""
    n = len(offsets) - 1
    owner = np.repeat(np.arange(n), np.diff(offsets))
    bins = ((shingles >> np.uint64(32)) * np.uint64(REGISTERS)) >> np.uint64(32)
    least = np.full(n * REGISTERS, EMPTY, dtype=np.uint64)
    np.minimum.at(least, owner * REGISTERS + bins.astype(np.int64), mixed(shingles + np.uint64(0x632BE59BD9B4E019)))
    filled = (least != EMPTY).reshape(n, REGISTERS)
    # Leading zeros from the exponent of the upper 53 bits, which a double holds exactly.
    _, exponent = np.frexp((least >> np.uint64(11)).astype(np.float64))
    zeros = np.minimum(53 - exponent, 53).astype(np.uint64)
    mantissa = (least << (zeros + np.uint64(1))) >> np.uint64(64 - MANTISSA)
    registers = ((zeros << np.uint64(MANTISSA)) | mantissa).astype(np.uint16).reshape(n, REGISTERS)
    orders = _borrowing()
    for i in np.flatnonzero(~filled.all(axis=1) & filled.any(axis=1)):
        holes = np.flatnonzero(~filled[i])
        asked = orders[holes]
        registers[i, holes] = registers[i, asked[np.arange(len(holes)), filled[i][asked].argmax(axis=1)]]
    return registers


@lru_cache(maxsize=4096)
def _chance(size: int, other: int) -> float:
    """Probability that registers of different shingles are equal, for bins of sets of 2**(size/4) and 2**(other/4)."""
    zeros, step = np.arange(40)[:, None], np.arange(1 << MANTISSA)[None, :] / (1 << MANTISSA)
    low = 2.0 ** -(zeros + 1) * (1 + step)
    high = low + 2.0 ** -(zeros + 1) / (1 << MANTISSA)
    a, b = (max(1.0, 2 ** (s / 4) / REGISTERS) for s in (size, other))
    p, q = ((1 - low) ** x - (1 - np.minimum(high, 1)) ** x for x in (a, b))
    return float((p * q).sum())


def estimate(equal: np.ndarray, sizes: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Similarity from the number of equal registers, corrected for chance."""
    logs = [np.round(4 * np.log2(np.maximum(x, 1))).astype(int).tolist() for x in (sizes, others)]
    chance = np.array([_chance(min(a, b), max(a, b)) for a, b in zip(*logs)])
    return (equal / REGISTERS - chance) / (1 - chance)


def possible(equal: np.ndarray, sizes: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Whether sizes and registers leave room for a link."""
    smaller, larger = np.minimum(sizes, others), np.maximum(sizes, others)
    need = THRESHOLD / 100
    margin = 5 * np.sqrt(need * (1 - need) / np.minimum(np.maximum(smaller, 1), REGISTERS))
    return (100 * smaller >= THRESHOLD * larger) & (estimate(equal, sizes, others) >= need - margin)


def _least(words: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The upper halves of the smallest shingle hashes of every set, in ascending order."""

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        shingles, offsets = shingle_sets(piece.column("text"), words)
        least = [(shingles[a : min(b, a + LEAST)] >> np.uint64(32)).astype(np.uint32) for a, b in zip(offsets[:-1], offsets[1:])]
        columns = [piece.column("id"), pa.array([x.tobytes() for x in least], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["id", "least"])

    return per_piece(work)


def similar_in_part(mine: np.ndarray, size: int, others: list[np.ndarray], sizes: np.ndarray) -> np.ndarray:
    """Whether the smallest shingles of one set and of each other set leave room for a link.

    Both are compared up to the largest value that both are known to. Equal halves of different hashes can only add to
    what is shared, so no link is lost; where both sets are known whole there is no margin.
    """
    top = np.uint32(0xFFFFFFFF)
    ends = np.array([x[-1] if n > LEAST else top for x, n in zip(others, sizes.tolist())], dtype=np.uint32)
    ends = np.minimum(ends, mine[-1] if size > LEAST else top)
    counts = np.array([len(x) for x in others])
    values, owner = np.concatenate(others), np.repeat(np.arange(len(others)), counts)
    known = values <= ends[owner]
    places = np.minimum(np.searchsorted(mine, values), len(mine) - 1)
    shared = np.bincount(owner[known & (mine[places] == values)], minlength=len(others))
    either = np.searchsorted(mine, ends, side="right") + np.bincount(owner[known], minlength=len(others)) - shared
    need = THRESHOLD / 100
    margin = np.where((sizes > LEAST) | (size > LEAST), 5 * np.sqrt(need * (1 - need) / np.maximum(either, 1)), 0)
    return 100 * shared >= (THRESHOLD - 100 * margin) * either - 1e-6


def _sketches(words: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        shingles, offsets = shingle_sets(piece.column("text"), words)
        digests = [xxhash.xxh3_128_digest(shingles[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
        registers = sketch(shingles, offsets)
        columns = [
            piece.column("doc_id"),
            pa.array(np.diff(offsets), pa.int64()),
            pa.array(digests, pa.binary()),
            pa.array([r.tobytes() for r in registers], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "size", "digest", "registers"])

    return per_piece(work)


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        registers = _matrix(batch.column("registers"))
        values = mixed(registers.astype(np.uint64) + np.uint64(1))
        columns = []
        for band in range(BANDS):
            key = np.full(len(batch), band + 1, dtype=np.uint64)
            for row in range(ROWS):
                key = joined(key, values[:, band + row * BANDS])
            columns.append(mixed(key))
        keys = np.stack(columns, axis=1).view(np.int64).ravel()
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(batch) + 1) * BANDS, pa.int32()), pa.array(keys))
        yield pa.RecordBatch.from_arrays([batch.column("id"), lists], ["id", "bands"])


def _matrix(column: pa.Array) -> np.ndarray:
    data, _ = flat(column)
    return np.ascontiguousarray(data).view(np.uint16).reshape(-1, REGISTERS)


def _possible_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        equal = (_matrix(batch.column("left")) == _matrix(batch.column("right"))).sum(axis=1)
        keep = possible(equal, batch.column("size").to_numpy(), batch.column("other").to_numpy())
        yield batch.select(["a", "b"]).filter(pa.array(keep))


def _within_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Possible pairs of different components among the rows of a pair of blocks; rows come group by group."""

    def pairs(rows: list[dict]) -> Iterator[pa.RecordBatch]:
        ids = np.array([r["id"] for r in rows], dtype=np.int64)
        own = np.array([r["component"] for r in rows], dtype=np.int64)
        sizes = np.array([r["size"] for r in rows], dtype=np.int64)
        registers = np.frombuffer(b"".join(r["registers"] for r in rows), dtype=np.uint16).reshape(-1, REGISTERS)
        least = [np.frombuffer(r["least"], dtype=np.uint32) for r in rows]
        left, right = [], []
        for i in range(len(rows) - 1):
            others = np.flatnonzero(own[i + 1 :] != own[i]) + i + 1
            others = others[100 * np.minimum(sizes[others], sizes[i]) >= THRESHOLD * np.maximum(sizes[others], sizes[i])]
            if len(others):
                equal = (registers[others] == registers[i]).sum(axis=1)
                hits = others[possible(equal, sizes[others], np.full(len(others), sizes[i]))]
                if len(hits):
                    hits = hits[similar_in_part(least[i], int(sizes[i]), [least[h] for h in hits], sizes[hits])]
                left.append(np.minimum(ids[hits], ids[i]))
                right.append(np.maximum(ids[hits], ids[i]))
        if left:
            columns = [pa.array(np.concatenate(x), pa.int64()) for x in (left, right)]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b"])

    held, group = [], None
    for batch in batches:
        for row in batch.to_pylist():
            own = (row["band"], row["low"], row["high"])
            if own != group and held:
                yield from pairs(held)
                held = []
            held.append(row)
            group = own
    if held:
        yield from pairs(held)


def _confirm(words: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Pairs whose full sets are similar enough; a centre comes before its members."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, centre_id = np.zeros(0, dtype=np.uint64), None
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                shingles, offsets = shingle_sets(part.column("text"), words)
                links = []
                rows = zip(part.column("centre").to_pylist(), part.column("id").to_pylist(), part.column("is_member").to_pylist())
                for i, (key, own, is_member) in enumerate(rows):
                    mine = shingles[offsets[i] : offsets[i + 1]]
                    if not is_member:
                        centre, centre_id = mine.copy(), key
                    elif key == centre_id:
                        places = np.searchsorted(centre, mine)
                        places[places == len(centre)] = 0
                        both = int((centre[places] == mine).sum()) if len(centre) else 0
                        if 100 * both >= THRESHOLD * (len(centre) + len(mine) - both):
                            links.append((key, own))
                columns = [pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays(columns, ["a", "b"])

    return run


def _links(texts: DataFrame, pairs: DataFrame, words: int) -> DataFrame:
    """The pairs (a, b) whose documents are similar enough."""
    shares = pairs.groupBy(F.col("a").alias("centre")).agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("shares"))
    members = pairs.join(shares, pairs.a == shares.centre).select(
        "centre", F.pmod(F.xxhash64("b"), F.col("shares")).alias("share"), F.lit(True).alias("is_member"), F.col("b").alias("id")
    )
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)).alias("share")
    centres = shares.select("centre", every, F.lit(False).alias("is_member"), F.col("centre").alias("id"))
    wanted = members.unionByName(centres)
    # Texts and ids always meet by a shuffle: the ids grow with the corpus.
    with_text = texts.withColumnRenamed("doc_id", "id").join(wanted.hint("merge"), "id")
    with_text = with_text.select("centre", "share", "is_member", "id", "text")
    ordered = with_text.repartition("centre", "share").sortWithinPartitions("centre", "share", "is_member")
    return ordered.mapInArrow(_confirm(words), "a long, b long")


def _ordered(left: Column, right: Column) -> list[Column]:
    return [F.least(left, right).alias("a"), F.greatest(left, right).alias("b")]


def find(docs: DataFrame, words: int = 5) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text): the size of its set, the smallest
    id that links lead to, and whether that is its own."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = texts.where("doc_id is not null")
    schema = "doc_id long, size long, digest binary, registers binary"
    sketches = materialize(texts.mapInArrow(_sketches(words), schema), "sketches")
    sets = materialize(
        sketches.where("size > 0 and doc_id is not null")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("id"), F.first("size").alias("size"), F.first("registers").alias("registers")),
        "sets",
    )
    banded = sets.select("id", "registers").mapInArrow(_bands, "id long, bands array<long>")
    bands = banded.select("id", F.explode("bands").alias("band"))
    centres = bands.groupBy("band").agg(
        F.min_by("id", F.xxhash64("band", "id")).alias("centre"), F.count(F.lit(1)).alias("members")
    )
    buckets = materialize(bands.join(centres.where("members > 1"), "band"), "buckets")

    stars = buckets.where("id <> centre").select(*_ordered(F.col("id"), F.col("centre"))).distinct()
    left = sets.select(F.col("id").alias("a"), "size", F.col("registers").alias("left"))
    right = sets.select(F.col("id").alias("b"), F.col("size").alias("other"), F.col("registers").alias("right"))
    sized = stars.join(left.drop("left"), "a").join(right.drop("right"), "b")
    fitting = sized.where(100 * F.least("size", "other") >= THRESHOLD * F.greatest("size", "other")).select("a", "b")
    compared = fitting.join(left, "a").join(right, "b")
    tried = materialize(compared.mapInArrow(_possible_pairs, "a long, b long"), "star_pairs")
    links = materialize(_links(known, tried, words), "star_links")

    near = components(links)
    members = buckets.join(near, "id", "left").withColumn("component", F.coalesce("component", "id"))
    mixed_ = members.groupBy("band").agg(
        F.count(F.lit(1)).alias("rows"), (F.min("component") < F.max("component")).alias("several")
    ).where("several")
    open_ = members.select("band", "id", "component").join(mixed_, "band").withColumn("blocks", F.ceil(F.col("rows") / BLOCK))
    block = F.pmod(F.xxhash64("id", "band"), F.col("blocks"))
    against = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("against")
    meeting = open_.select("band", "id", "component", block.alias("block"), against).select(
        "band", "id", "component", F.least("block", "against").alias("low"), F.greatest("block", "against").alias("high")
    )
    wanted = open_.select("id").distinct().hint("merge")
    smallest = known.withColumnRenamed("doc_id", "id").join(wanted, "id").mapInArrow(_least(words), "id long, least binary")
    details = sets.select("id", "size", "registers").join(smallest.dropDuplicates(["id"]), "id")
    described = meeting.join(details, "id")
    grouped = described.repartition("band", "low", "high").sortWithinPartitions("band", "low", "high")
    rest = grouped.mapInArrow(_within_blocks, "a long, b long").distinct().join(tried, ["a", "b"], "left_anti")
    more = materialize(_links(known, materialize(rest, "other_pairs"), words), "other_links")

    to = {end: near.select(F.col("id").alias(end), F.col("component").alias(f"of_{end}")) for end in ("a", "b")}
    between = more.join(to["a"], "a", "left").join(to["b"], "b", "left")
    between = between.select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b"))
    merged = components(between).select(F.col("id").alias("own"), F.col("component").alias("whole"))
    own = F.coalesce("component", "id")
    labelled = sets.select("digest", "id").join(near, "id", "left").select("digest", own.alias("own")).join(merged, "own", "left")
    labelled = labelled.select("digest", F.coalesce("whole", "own").alias("component_id"))
    result = sketches.select("doc_id", "size", "digest").join(labelled, "digest", "left")
    own = F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), own)
    return result.select(
        "doc_id",
        F.col("size").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def remove(docs: DataFrame, words: int = 5) -> DataFrame:
    """One row of ``docs`` for each group of near-duplicates, the one with the smallest id, with all its columns. Rows
    without an id stay."""
    kept = materialize(find(docs, words).where("kept and doc_id is not null").select("doc_id").distinct(), "kept")
    known = docs.where("doc_id is not null").join(kept, "doc_id").dropDuplicates(["doc_id"]).select(docs.columns)
    return known.unionByName(docs.where("doc_id is null"))
