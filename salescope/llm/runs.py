"""Periodic runs: stretches of a text in which words repeat at a fixed distance.

A run is a stretch of consecutive words with smallest period q and a length of at least ``max(least, 2 * q)`` that no
neighbouring word extends with that period. Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text, compared byte by byte.

Every word is appended to a suffix automaton. Its suffix links form a tree, kept as paths in splay trees (link-cut): all
nodes of a path have the same last occurrence. Access from the newest state to the root goes through the paths that hold
the suffixes of the text so far and recolours them with the new end. A path left behind ends at a suffix of some length
that ended last at an older place: if the distance of both ends is at most that length, there is a square of that period
at the end of the text, and it is extended to a run on both sides. The half of a square of smallest period q occurs last
exactly q words before its end, so each run is met when its second period is complete, with its smallest period.

Before that, words that no run can hold are left out: of two periods of at least six words together, every word lies in
a sequence of ``least // 2`` words that occurs twice in the same stretch. What remains is cut into stretches, and those
again, until nothing falls away. Sequences are told apart by hashes there, so a collision only costs time.

Work and memory: documents are independent rows, dealt by Spark. A task takes texts in pieces of 1 MB or one longer text;
a stretch of n words takes O(n log n) amortised steps and some 400 bytes a word, so one text is the bound. NULL and empty
texts have no words and no runs, their collapsed text is empty; repeated rows give repeated results; a NULL id stays NULL.
Columns other than ``doc_id`` and ``text`` are ignored, whatever they are called. Empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescope.llm.blocks import Words, covered, flat, joined, mixed, per_piece, run_hashes, whole_runs

LEAST = 12
SEPARATOR = r"[\x20\x09-\x0D]+"
Run = tuple[int, int, int]
RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


class _Links:
    """The tree of suffix links, kept as paths.

    Each path is a splay tree ordered by depth; its root points up to the node above the path and holds the word number
    at which the strings of the path ended last. Nodes are numbers, -1 is none.
    """

    def __init__(self, most: int):
        self.up, self.left, self.right, self.last = ([-1] * most for _ in range(4))

    def splay(self, x: int) -> None:
        """Make x the root of its splay tree."""
        up, left, right = self.up, self.left, self.right
        root = x
        while (y := up[root]) >= 0 and (left[y] == root or right[y] == root):
            root = y
        if root == x:
            return
        self.last[x] = self.last[root]
        above = up[root]
        while (y := up[x]) != above:
            z = up[y]
            if z != above:
                self.rotate(y if (left[z] == y) == (left[y] == x) else x)
            self.rotate(x)

    def rotate(self, x: int) -> None:
        """Lift x over its parent in the splay tree."""
        up, left, right = self.up, self.left, self.right
        y = up[x]
        z = up[y]
        if left[y] == x:
            moved = left[y] = right[x]
            right[x] = y
        else:
            moved = right[y] = left[x]
            left[x] = y
        if moved >= 0:
            up[moved] = y
        if z >= 0:
            if left[z] == y:
                left[z] = x
            elif right[z] == y:
                right[z] = x
        up[x], up[y] = z, x

    def insert_above(self, x: int, new: int) -> None:
        """Put a new node between x and the node above it, on the path of x."""
        self.splay(x)
        above = self.left[x]
        self.left[new], self.left[x], self.up[new] = above, new, x
        if above >= 0:
            self.up[above] = new

    def access(self, x: int, end: int) -> list[tuple[int, int]]:
        """(deepest node, last end) of every path from x to the top, deepest first; then all become one path of ``end``."""
        met, below, bottom = [], -1, x
        while x >= 0:
            self.splay(x)
            met.append((x, self.last[x]))
            rest = self.right[x]
            if rest >= 0:
                self.last[rest] = self.last[x]
            self.right[x], below, x = below, x, self.up[x]
        self.splay(bottom)
        self.last[bottom] = end
        return met


class _Automaton:
    """Suffix automaton over words; a state has the length of its longest string, its suffix link and its transitions.

    Most states have one transition, held in two lists; further ones are in a dictionary for the state.
    """

    def __init__(self, words: int):
        most = 2 * words + 2
        self.length, self.link, self.word, self.target = ([-1] * most for _ in range(4))
        self.further: dict[int, dict[int, int]] = {}
        self.length[0], self.size, self.newest = 0, 1, 0
        self.tree = _Links(most)

    def step(self, state: int, word: int) -> int:
        if self.word[state] == word:
            return self.target[state]
        more = self.further.get(state)
        return more.get(word, -1) if more else -1

    def connect(self, state: int, word: int, target: int) -> None:
        if self.word[state] in (-1, word):
            self.word[state], self.target[state] = word, target
        else:
            self.further.setdefault(state, {})[word] = target

    def append(self, word: int) -> None:
        new, at = self.size, self.newest
        self.size += 1
        self.length[new] = self.length[at] + 1
        while at >= 0 and (known := self.step(at, word)) < 0:
            self.connect(at, word, new)
            at = self.link[at]
        if at < 0:
            above = 0
        elif self.length[known] == self.length[at] + 1:
            above = known
        else:
            above = self.split(at, word, known)
        self.link[new] = self.tree.up[new] = above
        self.newest = new

    def split(self, at: int, word: int, known: int) -> int:
        """A state of its own for those strings of ``known`` that are no longer than the way through ``at``."""
        new = self.size
        self.size += 1
        self.length[new], self.link[new] = self.length[at] + 1, self.link[known]
        self.word[new], self.target[new] = self.word[known], self.target[known]
        if known in self.further:
            self.further[new] = dict(self.further[known])
        self.tree.insert_above(known, new)
        self.link[known] = new
        while at >= 0 and self.step(at, word) == known:
            self.connect(at, word, new)
            at = self.link[at]
        return new


def find_runs(words: list[int], least: int = LEAST) -> list[Run]:
    """(start, length, period) of every run, in order; words are compared as numbers."""
    automaton, found = _Automaton(len(words)), []
    # Last word of the newest run of each period: until then its squares are known.
    known: dict[int, int] = {}
    for end, word in enumerate(words):
        automaton.append(word)
        for state, last in automaton.tree.access(automaton.newest, end):
            period, matched = end - last, automaton.length[state]
            if last < 0 or matched < period or known.get(period, -1) >= end:
                continue
            start, stop = end - matched - period + 1, end + 1
            while start > 0 and words[start - 1] == words[start - 1 + period]:
                start -= 1
            while stop < len(words) and words[stop] == words[stop - period]:
                stop += 1
            known[period] = stop - 1
            if stop - start >= least:
                found.append((start, stop - start, period))
    return sorted(found, key=lambda run: (run[0], run[2]))


def stretches(hashes: np.ndarray, bounds: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of at least ``least`` words that can hold runs; texts are ranges in ``bounds``.

    In such a stretch every word lies in a sequence of ``least // 2`` words that the stretch holds twice.
    """
    starts, ends = bounds[:-1], bounds[1:]
    size = max(1, least // 2)
    while True:
        long = ends - starts >= max(least, 2)
        starts, ends = starts[long], ends[long]
        if not len(starts):
            return starts, ends
        places = np.concatenate([[0], np.cumsum(ends - starts)])
        own = np.repeat(np.arange(len(starts)), ends - starts)
        at = np.arange(places[-1]) + np.repeat(starts - places[:-1], ends - starts)
        firsts = whole_runs(places, size)
        sequences = joined(mixed(own[firsts].astype(np.uint64)), run_hashes(hashes[at], size)[firsts])
        order = np.argsort(sequences, kind="stable")
        same = sequences[order][1:] == sequences[order][:-1]
        twice = np.zeros(len(firsts), dtype=bool)
        twice[order[1:][same]] = twice[order[:-1][same]] = True
        kept = covered(firsts[twice], np.full(int(twice.sum()), size), len(at))
        if kept.all():
            return starts, ends
        edge = np.zeros(len(at) + 1, dtype=bool)
        edge[places] = True
        begins = np.flatnonzero(kept & (edge[:-1] | ~np.concatenate([[False], kept[:-1]])))
        stops = np.flatnonzero(kept & (edge[1:] | ~np.concatenate([kept[1:], [False]])))
        starts, ends = at[begins], at[stops] + 1


def _runs_of_piece(words: Words, least: int) -> dict[int, list[Run]]:
    """The runs of each text that has some, by the number of the text."""
    found: dict[int, list[Run]] = {}
    starts, ends = stretches(words.hashes(), words.bounds, least)
    texts = np.searchsorted(words.bounds, starts, side="right") - 1
    for text, start, end in zip(texts.tolist(), starts.tolist(), ends.tolist()):
        stretch = words.data[words.starts[start] : words.ends[end - 1]].tobytes().split()
        numbers: dict[bytes, int] = {}
        runs = find_runs([numbers.setdefault(word, len(numbers)) for word in stretch], least)
        shift = start - int(words.bounds[text])
        found.setdefault(text, []).extend((at + shift, length, period) for at, length, period in runs)
    return found


def collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words joined by one space, without those that a run contains after its first period."""
    starts = np.array([start + period for start, _, period in runs], dtype=np.int64)
    sizes = np.array([length - period for _, length, period in runs], dtype=np.int64)
    gone = covered(starts, sizes, len(words))
    return b" ".join([word for word, out in zip(words, gone.tolist()) if not out])


def _finder(least: int):
    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = flat(piece.column("text"))
        words = Words(data, offsets)
        found = _runs_of_piece(words, least)
        texts = []
        for i, (low, high) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
            own = data[low:high].tobytes().split()
            texts.append(collapsed(own, found[i]) if found.get(i) else b" ".join(own))
        lists = [[dict(zip(("start", "length", "period"), run)) for run in found.get(i, ())] for i in range(len(piece))]
        columns = [
            piece.column("doc_id"),
            pa.array(words.counts, pa.int64()),
            pa.array(lists, RUNS),
            pa.array(texts, pa.binary()).cast(pa.string()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed"])

    return per_piece(work)


def find(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(doc_id, n_words, runs array<struct<start, length, period>>, collapsed) for every row of ``docs`` (doc_id, text).

    ``runs`` are in order of start and period, places are word numbers from 0. ``collapsed`` is the text without the
    words that a run contains after its first period, words joined by one space.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return texts.mapInArrow(_finder(least), schema)


def looped_tail(docs: DataFrame) -> DataFrame:
    """(doc_id, text) in which a tenth of the texts, picked by a hash of the id, end in a loop of some of their words.

    With n words, h = crc32 of the decimal id, g = h div 10, a = g mod n and p = 1 + (n - a) div (3 + g mod 8), each word
    from number a on is the word a + (i - a) mod p. Other texts, and those without an id, stay as they are.
    """
    hashed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).withColumn("h", F.crc32(F.col("doc_id").cast("string").cast("binary")))
    words = F.filter(F.split("text", SEPARATOR), lambda word: word != "")
    chosen = hashed.withColumn("words", F.when(F.col("h") % 10 == 0, words))
    placed = chosen.withColumn("n", F.size("words")).withColumn("a", F.expr("if(n > 0, (h div 10) % n, null)"))
    looped = placed.withColumn("p", F.expr("1 + (n - a) div (3 + (h div 10) % 8)"))
    tail: Column = F.expr(
        "array_join(transform(sequence(0, n - 1), i -> words[int(if(i < a, i, a + (i - a) % p))]), ' ')"
    )
    return looped.select("doc_id", F.when(F.col("n") > 0, tail).otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """Per document: number of runs, the longest one, and digests of all runs and of the collapsed text."""
    listed = F.transform("runs", lambda run: F.concat(F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n")))
    # Greatest length, then smallest start and period.
    ordered = F.transform(
        "runs", lambda run: F.struct(run["length"].alias("length"), (-run["start"]).alias("start"), (-run["period"]).alias("period"))
    )
    longest = found.withColumn("longest", F.array_max(ordered))
    return longest.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.start")).alias("start"),
        F.col("longest.length").alias("length"),
        (-F.col("longest.period")).alias("period"),
        F.expr("(1000 * longest.length) div -longest.period").alias("exponent_milli"),
        F.sha2(F.array_join(listed, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
