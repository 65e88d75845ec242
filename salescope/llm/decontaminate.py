"""Benchmark decontamination by template windows, which also finds questions with other numbers, names or units.

A text becomes a list of tokens: words without marks at their ends, in lower case. Han and kana are written without
spaces, so each of their characters is a token. Numbers, units behind numbers, and names (capitalised words inside a
sentence) become typed placeholders. Every window of ``size`` tokens of a benchmark item is hashed, with placeholders and
as it is (twice ``size`` if most of the item is Han or kana, since a word has about two characters there); an item with
fewer tokens is one window of its own length. All windows of all documents are looked up in both forms.
Windows on the same diagonal (same distance between places in the document and in the item) belong together, and their
placeholders must be consistent: a value of the item stands for the value of the document that it meets most often on the
diagonal, and for none if it meets several once each. A window counts if all its values stand for what they meet, or equal
it; a conflict elsewhere on the diagonal does not matter.

Capitals tell names, so a copy in other case has other placeholders. Every window is therefore looked up in a form with
placeholders for numbers and units only too, and words are compared without case.

Windows with fewer than half literal tokens, and items of fewer than ``least`` tokens, say nothing once their
placeholders are open: only equal words match them. So an item of one word is found in every document with that word.
The first token of an item may be a name or not, since only there a capital depends on what stands before it.

The index of the benchmark goes to the tasks in blocks of bounded size, with one pass over the documents for each block.
Documents with NULL or empty text hold nothing; an item with NULL text or id is ignored; items of equal text are found
under each of their ids. Rows without ``doc_id`` are ignored. Repeated rows of a document count once in the result.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.llm.blocks import Words, binary_column, covered, flat, per_piece, ranges, run_hashes, whole_runs
from salescope.llm.idstore import IdStore

SIZE, LEAST = 13, 5
# Benchmark characters whose index one pass carries.
BLOCK_CHARS = 8 << 20
# Fixed words: units of measure, currency and time.
UNITS = frozenset(
    "mm cm m km in inch inches ft foot feet yd yard yards mile miles mg g kg t ton tons lb lbs oz pound pounds ml l liter liters "
    "litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks month months year "
    "years percent degree degrees dollar dollars cent cents euro euros meter meters metre metres gram grams kilogram kilograms "
    "kilometer kilometers kilometre kilometres mph kmh kb mb gb tb usd eur gbp".split()
)
NUMBER = re.compile(r"[+-]?[$€£]?\d[\d.,:/]*(?:%|st|nd|rd|th|°)?[a-z]{0,3}$")
MARKS = "\"'`.,;:!?()[]{}<>«»“”‘’„…-–—*_#|~　、。，．・：；！？「」『』（）〔〕［］｛｝〈〉《》【】～"
WORD, NUM, NAME, UNIT, EMPTY = range(5)
# Fixed hashes of the placeholders, by kind.
PLACEHOLDERS = np.array([0, 0x9AE16A3B2F90404F, 0xC949C7DEFEB1F5A3, 0xB492B66FBE98F273, 0], dtype=np.uint64)


def describe(word: str) -> tuple[int, bool, bool, str]:
    """Kind of a word seen alone, whether it has a name's capital, whether it ends a sentence, and the bare word."""
    bare = word.strip(MARKS)
    ends = word.rstrip("\"'”’)]»").endswith((".", "!", "?", ":", "…", "。", "！", "？", "："))
    if not bare:
        return EMPTY, False, ends, ""
    small = bare.lower()
    if NUMBER.match(small):
        return NUM, False, ends, small
    return (UNIT if small in UNITS else WORD), bare[0].isupper() and bare[1:] == bare[1:].lower(), ends, bare.casefold()


def unspaced(data: np.ndarray) -> np.ndarray:
    """Whether a character of Han, kana or their marks begins at each byte of UTF-8: U+3000 to U+9FFF, U+F900 to U+FAFF,
    U+FF00 to U+FFBF, and from U+20000 on."""
    begins = (data >= 0xE3) & (data <= 0xE9)
    for lead, low, high in ((0xEF, 0xA4, 0xAB), (0xEF, 0xBC, 0xBE), (0xF0, 0xA0, 0xBF)):
        places = np.flatnonzero(data[:-1] == lead)
        begins[places] |= (data[places + 1] >= low) & (data[places + 1] <= high)
    return begins


class Tokens:
    """Tokens of flat texts: template hash, the same with the words of names, value hash, whether it is a placeholder, and
    whether it is a character of a script without spaces; texts are ranges in ``bounds``."""

    def __init__(self, column: pa.Array, known: IdStore):
        data, offsets = flat(column)
        single = unspaced(data)
        at = np.flatnonzero(single)
        words = Words(data, offsets, np.concatenate((at, at + np.where(data[at] == 0xF0, 4, 3))) if len(at) else None)
        packed, offsets = words.packed()
        described, _ = known.look_up(binary_column(packed, offsets))
        described = described.reshape(-1, 4)
        kind, flags = described[:, 0] & 7, described[:, 0]
        value = (described[:, 1].astype(np.uint32).astype(np.uint64) << np.uint64(32)) | described[:, 2].astype(np.uint32)
        kept = kind != EMPTY
        # A word follows a sentence's end if the word before it, or marks alone in between, ended one.
        ended = np.ones(len(kind), dtype=bool)
        ended[1:] = (flags[:-1] & 16) > 0
        ended[words.bounds[:-1][words.bounds[:-1] < len(kind)]] = True
        text = words.texts()[kept]
        self.bounds = np.searchsorted(text, np.arange(len(words.counts) + 1))
        kind, capital, value, ended = kind[kept], (flags[kept] & 8) > 0, value[kept], ended[kept]
        first = np.zeros(len(kind), dtype=bool)
        first[self.bounds[:-1][self.bounds[:-1] < len(kind)]] = True
        after_number = np.zeros(len(kind), dtype=bool)
        after_number[1:] = (kind[:-1] == NUM) & ~first[1:]
        kind = np.where((kind == UNIT) & ~after_number, WORD, kind)
        kind = np.where((kind == WORD) & capital & ~ended, NAME, kind)
        self.open = kind != WORD
        self.single = single[words.starts][kept]
        self.value = value
        self.template = np.where(self.open, PLACEHOLDERS[kind], value)
        self.uncased = np.where(kind == NAME, value, self.template)


def word_store() -> IdStore:
    """Remembers the descriptions of words as four numbers each."""
    from salescope.llm.blocks import byte_hashes

    def make(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        seen = [describe(w.decode()) for w in words]
        bare = [s[3].encode() for s in seen]
        offsets = np.concatenate(([0], np.cumsum([len(b) for b in bare])))
        hashes = byte_hashes(np.frombuffer(b"".join(bare), dtype=np.uint8), offsets)
        rows = np.zeros((len(words), 4), dtype=np.int64)
        rows[:, 0] = [kind | 8 * capital | 16 * ends for kind, capital, ends, _ in seen]
        rows[:, 1] = (hashes >> np.uint64(32)).astype(np.uint32).view(np.int32)
        rows[:, 2] = hashes.astype(np.uint32).view(np.int32)
        return rows.ravel().astype(np.int32), np.full(len(words), 4, dtype=np.int64)

    return IdStore(make)


@dataclass
class Index:
    """Windows of a block of benchmark items, with placeholders and as they are, sorted by hash within each window size:
    hash, item, offset in the item, and hash of the values."""

    items: np.ndarray
    bounds: np.ndarray
    value: np.ndarray
    open: np.ndarray
    windows: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]

    @classmethod
    def of(cls, items: list[tuple[int, str]], size: int, least: int) -> Index:
        tokens = Tokens(pa.array([text for _, text in items], pa.string()), word_store())
        counts = np.diff(tokens.bounds)
        singles = np.diff(np.concatenate(([0], np.cumsum(tokens.single)))[tokens.bounds])
        spans = np.minimum(counts, np.where(2 * singles > counts, 2 * size, size))
        windows = {}
        for span in sorted(set(spans[spans > 0].tolist())):
            starts = whole_runs(tokens.bounds, span)
            owner = np.searchsorted(tokens.bounds, starts, side="right") - 1
            starts, owner = starts[spans[owner] == span], owner[spans[owner] == span]
            long = starts[counts[owner] >= least]
            told, named = (
                long[2 * (literal[long + span] - literal[long]) >= span]
                for literal in (np.concatenate(([0], np.cumsum(form == tokens.value))) for form in (tokens.template, tokens.uncased))
            )
            opening = told[np.isin(told, tokens.bounds)]
            changed = tokens.template.copy()
            changed[opening] = PLACEHOLDERS[NAME]
            values = run_hashes(tokens.value, span)
            places = np.concatenate((starts, told, opening, named))
            hashes = np.concatenate(
                (
                    values[starts],
                    run_hashes(tokens.template, span)[told],
                    run_hashes(changed, span)[opening],
                    run_hashes(tokens.uncased, span)[named],
                )
            )
            order = np.lexsort((places, hashes))
            hashes, places = hashes[order], places[order]
            new = np.concatenate(([True], (np.diff(hashes) != 0) | (np.diff(places) != 0)))
            hashes, places = hashes[new], places[new]
            owner = np.searchsorted(tokens.bounds, places, side="right") - 1
            windows[span] = hashes, owner, places - tokens.bounds[owner], values[places]
        return cls(np.array([i for i, _ in items], dtype=np.int64), tokens.bounds, tokens.value, tokens.open, windows)

    def hits(self, tokens: Tokens) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
        """(text, item, place of the item's start) and offset in the item of every matching window, whether its values are
        the item's, and the window size; windows of one diagonal follow each other."""
        for span, (hashes, owner, offset, values) in self.windows.items():
            starts = whole_runs(tokens.bounds, span)
            if not len(starts):
                continue
            marked = np.zeros(1 << 20, dtype=bool)
            marked[(hashes >> np.uint64(44)).astype(np.int64)] = True
            place, which = [], []
            for form in (tokens.template, tokens.uncased, tokens.value):
                probes = run_hashes(form, span)[starts]
                near = np.flatnonzero(marked[(probes >> np.uint64(44)).astype(np.int64)])
                low = np.searchsorted(hashes, probes[near], side="left")
                count = np.searchsorted(hashes, probes[near], side="right") - low
                place.append(np.repeat(starts[near], count))
                which.append(ranges(low, count))
            place, which = np.concatenate(place), np.concatenate(which)
            if not len(place):
                continue
            text = np.searchsorted(tokens.bounds, place, side="right") - 1
            keys = np.stack([text, owner[which], place - offset[which], offset[which]], axis=1)
            order = np.lexsort(keys.T[::-1])
            order = order[np.concatenate(([True], (np.diff(keys[order], axis=0) != 0).any(axis=1)))]
            # ``probes`` is of the values here.
            same = probes[np.searchsorted(starts, place[order])] == values[which[order]]
            yield keys[order, :3], keys[order, 3], same, span

    def judged(self, tokens: Tokens, item: int, diagonal: int, offsets: np.ndarray, same: np.ndarray, span: int) -> tuple[int, int]:
        """Number of windows whose open values stand for what they meet in the document, and of values that differ there."""
        places = np.unique((offsets[:, None] + np.arange(span)).ravel())
        mine, theirs = self.value[self.bounds[item] + places], tokens.value[diagonal + places]
        both = tokens.open[diagonal + places] & self.open[self.bounds[item] + places]
        pairs, pair, counts = np.unique(np.stack([mine[both], theirs[both]], axis=1), axis=0, return_inverse=True, return_counts=True)
        # For each value of the item, its pairs by falling count: the first one stands, unless it and the next were met once.
        order = np.lexsort((-counts, pairs[:, 0]))
        first = np.ones(len(order), dtype=bool)
        first[1:] = np.diff(pairs[order, 0]) != 0
        alone = first.copy()
        alone[:-1] &= first[1:]
        stands = np.zeros(len(order), dtype=bool)
        stands[order] = first & (alone | (counts[order] > 1))
        wrong = np.zeros(len(places), dtype=np.int64)
        wrong[both] = ~stands[pair.ravel()]
        low, high = np.searchsorted(places, offsets), np.searchsorted(places, offsets + span)
        upto = np.concatenate(([0], np.cumsum(wrong)))
        good = same | (upto[high] == upto[low])
        seen = covered(low[good], (high - low)[good], len(places)) & both
        differ = np.unique(np.stack([mine[seen], theirs[seen]], axis=1), axis=0)
        return int(good.sum()), int((differ[:, 0] != differ[:, 1]).sum())

    def passages(self, tokens: Tokens) -> np.ndarray:
        """Rows (text, item, windows, changed values) of every text that holds a passage of an item."""
        found = [np.zeros((0, 4), dtype=np.int64)]
        for keys, offsets, same, span in self.hits(tokens):
            first = np.flatnonzero(np.concatenate(([True], (np.diff(keys, axis=0) != 0).any(axis=1))))
            ends = np.concatenate((first[1:], [len(keys)]))
            rows = np.zeros((len(first), 4), dtype=np.int64)
            rows[:, :2] = keys[first, :2]
            rows[:, 2] = np.add.reduceat(same.astype(np.int64), first)
            for i in np.flatnonzero(rows[:, 2] < ends - first):
                part = slice(first[i], ends[i])
                rows[i, 2:] = self.judged(tokens, rows[i, 1], keys[first[i], 2], offsets[part], same[part], span)
            found.append(rows[rows[:, 2] > 0])
        rows = np.concatenate(found)
        rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
        if not len(rows):
            return rows
        first = np.flatnonzero(np.concatenate(([True], (np.diff(rows[:, :2], axis=0) != 0).any(axis=1))))
        return np.concatenate((rows[first, :2], np.maximum.reduceat(rows[:, 2:], first)), axis=1)


def _finder(index: Index) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    known: list[IdStore] = []

    def work(piece: pa.RecordBatch) -> pa.RecordBatch | None:
        if not known:
            known.append(word_store())
        rows = index.passages(Tokens(piece.column("text"), known[0]))
        ids = piece.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
        columns = [pa.array(c) for c in (ids[rows[:, 0]], index.items[rows[:, 1]], rows[:, 2], rows[:, 3])]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "n_windows", "n_changed"])

    return per_piece(work)


def _indexes(benchmark: DataFrame, size: int, least: int) -> Iterator[Index]:
    """One index after the other, each of a share of the items that fits a task."""
    items = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("long"), F.col("text").cast("string")).distinct()
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-chars // BLOCK_CHARS)
    for block in range(blocks):
        share = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        yield Index.of([(r.item_id, r.text) for r in share.collect()], size, least)


def find(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, least: int = LEAST) -> DataFrame:
    """(doc_id, item_id, n_windows, n_changed): each document that holds a passage of an item, with the number of matching
    windows and of placeholders whose value was changed."""
    texts = docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    schema = "doc_id long, item_id long, n_windows long, n_changed long"
    parts = [texts.mapInArrow(_finder(index), schema) for index in _indexes(benchmark, size, least)]
    if not parts:
        return docs.sparkSession.createDataFrame([], schema)
    return (
        reduce(DataFrame.unionAll, parts)
        .groupBy("doc_id", "item_id")
        .agg(F.max("n_windows").alias("n_windows"), F.max("n_changed").alias("n_changed"))
    )


def _keeper(index: Index) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    known: list[IdStore] = []

    def work(piece: pa.RecordBatch) -> pa.RecordBatch | None:
        if not known:
            known.append(word_store())
        clean = np.ones(len(piece), dtype=bool)
        clean[index.passages(Tokens(piece.column("text"), known[0]))[:, 0]] = False
        return piece.filter(pa.array(clean))

    return per_piece(work)


def remove(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, least: int = LEAST) -> DataFrame:
    """The rows of ``docs`` that hold no passage of the benchmark, with all their columns."""
    kept = docs
    for index in _indexes(benchmark, size, least):
        kept = kept.mapInArrow(_keeper(index), docs.schema)
    return kept
