"""Token ids in files: Simple-8b words with an escape, in blocks whose places are listed for vectorised decoding.

A file row is one segment: the ids of whole documents in ascending ``doc_id`` order. Its bytes are

    magic "S8B1", then six unsigned 32-bit numbers: documents, ids, distinct ids, blocks, words, 0
    distinct ids, unsigned 64-bit, the most frequent first
    offset of each block in the words, unsigned 32-bit
    words, unsigned 64-bit, little-endian

An id is written as its place in the list of distinct ids, so that frequent ids need few bits. Each word has a selector
in its upper four bits, which says how many numbers of how many bits the other sixty hold, the first one lowest. A block
is ``BLOCK`` numbers (fewer at the end) and starts a new word, so all blocks can be decoded side by side.

Selector 14 stands for 120 zeros, selector 15 for one number of 60 bits or more in the next word.

NULL and empty texts hold the end id alone. Rows with equal ids are ordered by their text, NULL ids come first; other
columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salescope.llm.blocks import Words, binary_column, flat, lowered, pieces
from salescope.llm.idstore import IdStore

MAGIC = b"S8B1"
BLOCK = 1024
SEGMENT_IDS = 1 << 20
# Ids below this are counted in one array.
DENSE = 1 << 20
# Fixed values of the code: numbers in a word and bits of each, by selector.
COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 120, 1], dtype=np.int64)
BITS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60, 0, 64], dtype=np.int64)
ZEROS, ESCAPE = 14, 15
BY_COUNT = [int(s) for s in np.argsort(COUNTS[:14], kind="stable")] + [ZEROS]
FILE_SCHEMA = "part int, start long, n_ids long, doc_ids array<long>, sizes array<int>, data binary"


# Bits of the numbers that most ids are written as.
NARROW = np.array([i.bit_length() for i in range(1 << 16)], dtype=np.uint8)


def widths(values: np.ndarray) -> np.ndarray:
    """Bits that each number needs."""
    if not len(values) or values.max() < len(NARROW):
        return NARROW[values]
    found = np.zeros(len(values), dtype=np.uint8)
    rest = values.copy()
    for step in (32, 16, 8, 4, 2, 1):
        large = rest >= np.uint64(1 << step)
        found[large] += np.uint8(step)
        rest[large] >>= np.uint64(step)
    return found + (rest > 0)


def _selectors(values: np.ndarray) -> np.ndarray:
    """For every place of blocks, with zeros behind them, the selector that packs most numbers from there on."""
    best = np.full((len(values), BLOCK), ESCAPE, dtype=np.uint8)
    largest, size = widths(values.ravel()).reshape(values.shape), 1
    for selector in BY_COUNT:
        count = int(COUNTS[selector])
        while size < count:
            step = min(size, count - size)
            largest = np.maximum(largest[:, : largest.shape[1] - step], largest[:, step:])
            size += step
        best[largest[:, :BLOCK] <= BITS[selector]] = selector
    return best


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of all blocks of ``values``, and each block's offset in them."""
    total = len(values)
    rows = -(-total // BLOCK)
    padded = np.zeros(rows * BLOCK, dtype=np.uint64)
    padded[:total] = values
    blocks = np.zeros((rows, BLOCK + int(COUNTS.max())), dtype=np.uint64)
    blocks[:, :BLOCK] = padded.reshape(rows, BLOCK)
    best = _selectors(blocks)
    ends = np.minimum(total - np.arange(rows) * BLOCK, BLOCK)
    at, alive = np.zeros(rows, dtype=np.int64), np.arange(rows)
    starts, chosen = [at], [at]
    while len(alive):
        selector = best[alive, at[alive]]
        starts.append(alive * blocks.shape[1] + at[alive])
        chosen.append(selector)
        at[alive] += COUNTS[selector]
        alive = alive[at[alive] < ends[alive]]
    start, selector = np.concatenate(starts[1:] or starts), np.concatenate(chosen[1:] or chosen).astype(np.int64)
    order = np.argsort(start, kind="stable")
    start, selector = start[order], selector[order]
    place = np.cumsum(np.where(selector == ESCAPE, 2, 1))
    words = np.zeros(int(place[-1]) if rows else 0, dtype=np.uint64)
    place -= np.where(selector == ESCAPE, 2, 1)
    numbers = blocks.ravel()
    for s in np.unique(selector):
        which = np.flatnonzero(selector == s)
        packed = np.full(len(which), int(s) << 60, dtype=np.uint64)
        if s == ESCAPE:
            words[place[which] + 1] = numbers[start[which]]
        elif s != ZEROS:
            for i in range(int(COUNTS[s])):
                packed |= numbers[start[which] + i] << np.uint64(i * int(BITS[s]))
        words[place[which]] = packed
    return words, place[np.searchsorted(start, np.arange(rows) * blocks.shape[1])]


def unpack(words: np.ndarray, offsets: np.ndarray, total: int) -> np.ndarray:
    """The numbers again."""
    rows = len(offsets)
    ends = np.append(offsets[1:], len(words)).astype(np.int64)
    escaped = np.zeros(len(words) + 1, dtype=bool)
    at, alive = offsets.astype(np.int64), np.arange(rows)
    # A word that follows an escape is not a selector word; only blocks with escapes need the walk.
    if (words >> np.uint64(60) == ESCAPE).any():
        while len(alive):
            jump = words[at[alive]] >> np.uint64(60) == ESCAPE
            escaped[at[alive[jump]] + 1] = True
            at[alive] += np.where(jump, 2, 1)
            alive = alive[at[alive] < ends[alive]]
    heads = np.flatnonzero(~escaped[:-1])
    selector = (words[heads] >> np.uint64(60)).astype(np.int64)
    block = np.searchsorted(offsets, heads, side="right") - 1
    counts = COUNTS[selector]
    before = np.cumsum(counts) - counts
    first = np.searchsorted(heads, offsets)
    start = before - before[first][block] + block * BLOCK
    result = np.zeros(rows * BLOCK + int(COUNTS.max()), dtype=np.uint64)
    limit = np.minimum((block + 1) * BLOCK, total)
    for s in np.unique(selector):
        which = np.flatnonzero(selector == s)
        if s == ESCAPE:
            result[start[which]] = words[heads[which] + 1]
        elif s != ZEROS:
            mask = np.uint64((1 << int(BITS[s])) - 1)
            for i in range(int(COUNTS[s])):
                inside = which[start[which] + i < limit[which]]
                result[start[inside] + i] = (words[heads[inside]] >> np.uint64(i * int(BITS[s]))) & mask
    return result[:total]


def encode_segment(ids: np.ndarray, documents: int) -> bytes:
    """The bytes of one segment."""
    if len(ids) and ids.max() < DENSE:
        counts = np.bincount(ids)
        distinct = np.flatnonzero(counts)
        counts, coded = counts[distinct], (np.cumsum(counts > 0) - 1)[ids]
    else:
        distinct, coded, counts = np.unique(ids, return_inverse=True, return_counts=True)
    order = np.argsort(-counts, kind="stable")
    rank = np.empty(len(order), dtype=np.uint64)
    rank[order] = np.arange(len(order), dtype=np.uint64)
    words, offsets = pack(rank[coded])
    head = np.array([documents, len(ids), len(distinct), len(offsets), len(words), 0], dtype="<u4")
    parts = (head, distinct[order].astype("<u8"), offsets.astype("<u4"), words.astype("<u8"))
    return MAGIC + b"".join(p.tobytes() for p in parts)


def decode_segment(data: bytes) -> np.ndarray:
    """The ids of one segment."""
    if data[:4] != MAGIC:
        raise ValueError("not a segment of token ids")
    _, total, distinct, blocks, words, _ = np.frombuffer(data, "<u4", 6, 4).tolist()
    at = 28
    known = np.frombuffer(data, "<u8", distinct, at)
    offsets = np.frombuffer(data, "<u4", blocks, at + 8 * distinct)
    packed = np.frombuffer(data, "<u8", words, at + 8 * distinct + 4 * blocks)
    return known[unpack(packed, offsets, total).astype(np.int64)] if total else known[:0]


def byte_of(name: str) -> int:
    """The byte that a letter of the byte-level alphabet stands for: visible bytes name themselves, others follow 255."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    code = ord(name)
    return code if code in visible else [b for b in range(256) if b not in visible][code - 256]


class WordTokenizer:
    """Ids of texts by a tokenizer with lower case and a pattern of letters, single numbers and other runs.

    Its tokens never reach over white space, nor from a letter to an ASCII mark, nor from a mark other than ``'`` to a
    letter, so texts are cut there and each distinct cut is encoded once. The marks of special tokens stay uncut. Capitals
    A-Z are put in lower case before that, unless a special token may be in the texts, since those are found before
    letters change.
    """

    MARKS = np.isin(np.arange(256), list(b"!\"#$%&()*+,-./:;=?@[\\]^_`{}~"))
    # Second bytes, after C3, of the Latin-1 signs that are no letters.
    SIGNS = (0x97, 0xB7)
    # Letters below this code point stay one letter in lower case and in composed form.
    PLAIN = "\u0250"
    # Distinct cuts in each generation of the store.
    STORED = 300_000
    # The end of the last token of a word, in names of tokens.
    SUFFIX = "</w>"

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.merges = Tokenizer(self.tokenizer.model)
        self.names = {byte_of(n): n for n in pre_tokenizers.ByteLevel.alphabet()}
        vocabulary = self.merges.get_vocab(with_added_tokens=False)
        self.last = np.zeros(max(vocabulary.values(), default=-1) + 1, dtype=bool)
        self.last[[i for name, i in vocabulary.items() if name.endswith(self.SUFFIX)]] = True
        self.store = IdStore(self._make, self.STORED)

    def _letters(self, named: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of letters, by their names in the byte-level alphabet, and the number of ids of each word."""
        groups = [named[at : at + 1000] for at in range(0, len(named), 1000)]
        quick = self.merges.encode_batch_fast(groups, is_pretokenized=True, add_special_tokens=False)
        ids = np.fromiter(chain.from_iterable(e.ids for e in quick), dtype=np.int32)
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) == len(named) and (not len(ids) or ends[-1] == len(ids)):
            return ids, np.diff(ends, prepend=0)
        # A word without a token of its own at the end: ask for the word of every token.
        encoded = self.merges.encode(named, is_pretokenized=True, add_special_tokens=False)
        owners = np.array(encoded.word_ids, dtype=np.int64)
        return np.array(encoded.ids, dtype=np.int32), np.bincount(owners, minlength=len(named))

    def _make(self, cuts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of cuts. One that is all letters is a single token of the pattern and goes straight to the merges."""
        texts = [c.decode() for c in cuts]
        plain = np.array([t.isalpha() and (t.isascii() or (max(t) < self.PLAIN and "\u0130" not in t)) for t in texts], dtype=bool)
        letters, others = np.flatnonzero(plain), np.flatnonzero(~plain)
        lower = [texts[i].lower() for i in letters]
        named = [t if t.isascii() else t.encode().decode("latin-1").translate(self.names) for t in lower]
        ids, sizes = self._letters(named)
        rest = self.tokenizer.encode_batch_fast([texts[i] for i in others], add_special_tokens=False)
        counts = np.zeros(len(cuts), dtype=np.int64)
        counts[letters], counts[others] = sizes, [len(e.ids) for e in rest]
        found = np.zeros(int(counts.sum()), dtype=np.int32)
        of_letters = np.repeat(plain, counts)
        found[of_letters] = ids
        found[~of_letters] = np.fromiter(chain.from_iterable(e.ids for e in rest), dtype=np.int32)
        return found, counts

    def _breaks(self, data: np.ndarray) -> np.ndarray:
        """Places between a letter and a mark."""
        letter = (data >= ord("a")) & (data <= ord("z"))
        mark = self.MARKS[data]
        latin = np.zeros(len(data), dtype=bool)
        latin[1:] = (data[:-1] == 0xC3) & (data[1:] != self.SIGNS[0]) & (data[1:] != self.SIGNS[1])
        return np.flatnonzero(((letter | latin)[:-1] & mark[1:]) | (mark[:-1] & letter[1:])) + 1

    def encode(self, column: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, each text with the end id, and the number of ids of each text."""
        data, offsets = flat(column)
        if not ((data[:-1] == ord("<")) & (data[1:] == ord("|"))).any():
            data = lowered(data)
        words = Words(data, offsets, self._breaks(data))
        ids, bounds = self.store.look_up(binary_column(*words.packed()))
        ends = bounds[words.bounds[1:]]
        return np.insert(ids, ends, end_id), np.diff(np.concatenate(([0], ends))) + 1


@lru_cache(maxsize=2)
def tokenizer(path: str) -> WordTokenizer:
    """Read a tokenizer file once per worker."""
    return WordTokenizer(path)


def _segments(path: str, end_id: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, start = TaskContext.get().partitionId(), 0
        docs, ids, sizes, held = [], [], [], 0

        def segment() -> pa.RecordBatch:
            nonlocal docs, ids, sizes, held, start
            owners, all_ids, all_sizes = pa.concat_arrays(docs), np.concatenate(ids), np.concatenate(sizes)
            columns = [
                pa.array([part], pa.int32()),
                pa.array([start], pa.int64()),
                pa.array([held], pa.int64()),
                pa.ListArray.from_arrays(pa.array([0, len(owners)], pa.int32()), owners),
                pa.ListArray.from_arrays(pa.array([0, len(owners)], pa.int32()), pa.array(all_sizes, pa.int32())),
                pa.array([encode_segment(all_ids, len(owners))], pa.binary()),
            ]
            start += held
            docs, ids, sizes, held = [], [], [], 0
            return pa.RecordBatch.from_arrays(columns, ["part", "start", "n_ids", "doc_ids", "sizes", "data"])

        for batch in batches:
            for piece in pieces(batch, "text", 2 << 20):
                new, counts = tokenizer(path).encode(piece.column("text"), end_id)
                docs.append(piece.column("doc_id"))
                ids.append(new)
                sizes.append(counts)
                held += len(new)
                if held >= SEGMENT_IDS:
                    yield segment()
        if docs:
            yield segment()

    return run


def write_ids(docs: DataFrame, path: str, folder: str, end_id: int = 1) -> None:
    """Encode every text of ``docs`` (doc_id, text) and write the segments below ``folder``."""
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    ordered = texts.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(_segments(path, end_id), FILE_SCHEMA).write.parquet(folder)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = decode_segment(row["data"]).astype("<u4")
            sizes = np.array(row["sizes"], dtype=np.int64)
            ends = np.cumsum(sizes)
            sums = [zlib.crc32(ids[e - n : e]) for e, n in zip(ends.tolist(), sizes.tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(row["start"] + ends - sizes, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(sums, pa.int64()),
                    pa.array(np.full(len(ends), row["part"]), pa.int32()),
                ],
                ["doc_id", "start", "n_tokens", "ids_crc32", "part"],
            )


def read_digests(spark: SparkSession, folder: str) -> DataFrame:
    """Per document, from the files: place of its first id among all ids, number of ids, checksum of the ids.

    Files of one task are numbered from its first id; the tasks' totals, one row for each task, are added up here.
    """
    files = spark.read.schema(FILE_SCHEMA).parquet(folder)
    totals = files.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("base"))
    read = files.mapInArrow(_documents, "doc_id long, start long, n_tokens long, ids_crc32 long, part int")
    placed = read.join(F.broadcast(bases), "part")
    return placed.select("doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids_crc32")
