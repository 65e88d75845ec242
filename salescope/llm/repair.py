"""Repair of the structure of conversations by the cheapest edits, found by iterative-deepening A*.

A sound conversation is empty, or an optional system turn followed by pairs of a user and an assistant turn, told by the
first letters of the roles. Each turn has at most one fault, the first that holds: *blank* (no character but white space),
*duplicate* (role and text of an earlier turn), *truncated* (its last character that is no white space does not end a
sentence). Edits are Keep (free), Rerole to user or assistant (2), Delete (3; blank and duplicate turns must go) and Insert
an empty user or assistant turn anywhere (2); a truncated turn that stays costs 1 more. Of the cheapest repairs the one
whose edit letters come first in ASCII order is taken.

Which role comes next follows from the turns so far, so a place in the search is a turn and one of four states. The search
goes down edit by edit in ASCII order and gives a branch up when its cost and the least cost still to come exceed the
bound; the bound is then raised to the least cost that exceeded it. A table holds for each place the cost at least still to
come: at first that of the edits no repair avoids, then what failed searches from there proved, for all later bounds. The
first accepting path within the bound is the answer. Turns are searched in blocks from the last one backwards, each from
its four states, so the table is exact behind the block in hand and a long conversation takes linear time.

Spark marks the faults, sorts each conversation and streams through it twice: first through one letter a turn for the
search, then through the turns themselves with the edits in front. A task holds the letters of one conversation, the table
(32 bytes a turn) and the edits, which the result has as one text anyway, never its texts; so a conversation may hold any
share of the rows. Duplicates are marked in groups of equal role and text, before conversations come together.

Turns go by ``turn``, NULL first, then role, then a digest of the text; repeated rows are repeated turns. NULL roles and
texts are empty: such a role cannot be kept, such a text is blank. Rows with NULL ``conv_id`` are one conversation. Other
columns are ignored, whatever they are called. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salescope.sources.scratch import materialize

VISIBLE = r"[^\x20\x09-\x0D]"
UNFINISHED = r"[^.!?\x20\x09-\x0D][\x20\x09-\x0D]*\z"
SENTENCE_END = "[.!?]"
LEGAL_PAIRS = ("su", "ua", "au")
# What a state allows next, by first letter: the start, after the system turn, after a user, after an assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
FREE_ROLE = ((USER, "user"), (USER, "user"), (ASSISTANT, "assistant"), (USER, "user"))
SOUND = (START, ASSISTANT)
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
BLOCK = 64
FAULTS = ("blank", "duplicate", "truncated")
CACHED_TURNS = 32
# Ascending, so NULL comes first.
TURN_ORDER = ("turn", "role", "digest")
PLAN = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
TURNS = "conv_id long, place long, edit string, role string, text string"


class _Search:
    """Cheapest repair of one conversation, given a letter per turn: the role's (``x`` for other roles), a capital one for a
    truncated turn, or ``-`` if the turn must go."""

    def __init__(self, turns: str):
        self.turns, n = turns, len(turns)
        # At least still to come from (turn, state); behind the last turn an unsound state needs an insert.
        self.least = [0] * (4 * n) + [0 if state in SOUND else INSERT for state in range(4)]

    def truncated(self, at: int) -> bool:
        return self.turns[at].isupper()

    def edits(self, at: int, state: int) -> list[tuple[str, int, int, int]]:
        """(letter, cost, next turn, next state) of the edits at a place, in ASCII order."""
        made, (free, _) = [], FREE_ROLE[state]
        if at < len(self.turns):
            made.append(("D", DELETE, at + 1, state))
        made.append(("I", INSERT, at, free))
        if at < len(self.turns) and self.turns[at] != "-":
            more, letter = TRUNCATED if self.truncated(at) else 0, self.turns[at].lower()
            if letter in NEXT[state]:
                made.append(("K", KEEP + more, at + 1, NEXT[state][letter]))
            made.append(("R", REROLE + more, at + 1, free))
        return made

    def within(self, at: int, state: int, bound: int, known: int | None = None) -> list[str] | None:
        """The first path in ASCII order from a place to a sound end that costs at most ``bound``; the table learns.

        From turn ``known`` on the table is exact, so a place there that fits the bound does lead to an end.
        """
        least, n = self.least, len(self.turns)
        path: list[str] = []
        # Per open place: itself, what it may cost from here, its edits, the next one, the least cost of those tried.
        stack = [[at, state, bound, self.edits(at, state), 0, None]]
        while stack:
            place = stack[-1]
            at, state, left, edits, tried, best = place
            if tried == 0 and (at == known or (at == n and state in SOUND)):
                return path
            if tried == len(edits):
                stack.pop()
                slot = 4 * at + state
                least[slot] = max(least[slot], best)
                if stack:
                    path.pop()
                    above = stack[-1]
                    cost = above[3][above[4] - 1][1] + least[slot]
                    above[5] = cost if above[5] is None else min(above[5], cost)
                continue
            letter, cost, to, then = edits[tried]
            place[4] += 1
            ahead = cost + least[4 * to + then]
            if ahead > left:
                place[5] = ahead if best is None else min(best, ahead)
                continue
            path.append(letter)
            stack.append([to, then, left - cost, self.edits(to, then), 0, None])
        return None

    def deepen(self, at: int, state: int, known: int | None = None) -> tuple[int, list[str]]:
        """The least bound that admits a path from a place, and the first path within it."""
        while True:
            bound = self.least[4 * at + state]
            path = self.within(at, state, bound, known)
            if path is not None:
                return bound, path

    def expect(self, block: int, known: int) -> None:
        """Start the table of a block: turns that must go, a unit for each truncated one, and the least cost behind it."""
        rest = min(self.least[4 * known : 4 * known + 4])
        for at in range(known - 1, block - 1, -1):
            rest += DELETE if self.turns[at] == "-" else TRUNCATED if self.truncated(at) else 0
            self.least[4 * at : 4 * at + 4] = [rest] * 4

    def repair(self) -> tuple[int, str]:
        """(cost, edit letters) of the cheapest repair, the first in ASCII order among those."""
        known = len(self.turns)
        for state in range(4):
            self.deepen(known, state)
        for block in range((known - 1) // BLOCK * BLOCK, -1, -BLOCK):
            self.expect(block, known)
            for state in range(4) if block else [START]:
                self.deepen(block, state, known)
            known = block
        cost, path = self.deepen(0, START)
        return cost, "".join(path)


@lru_cache(maxsize=50_000)
def _remembered(turns: str) -> tuple[int, str]:
    return _Search(turns).repair()


def cheapest(turns: str) -> tuple[int, str]:
    """(cost, edit letters) for a letter per turn, as in ``_Search``; those of short conversations are remembered."""
    return _remembered(turns) if len(turns) <= CACHED_TURNS else _Search(turns).repair()


class _Conversation:
    """What the plan needs of the turns that went by: counts, and a letter per turn."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.letters, self.faults = conv_id, [], dict.fromkeys(FAULTS, 0)
        self.first = self.turn = self.initial = None
        self.distinct = self.illegal = 0

    def add(self, turn: int | None, letter: str, fault: str | None) -> None:
        if turn is not None and turn != self.turn:
            self.first = turn if self.first is None else self.first
            self.turn, self.distinct = turn, self.distinct + 1
        if self.initial is not None and self.initial + letter not in LEGAL_PAIRS:
            self.illegal += 1
        self.initial = letter
        if fault is not None:
            self.faults[fault] += 1
        gone = fault in ("blank", "duplicate")
        self.letters.append("-" if gone else letter.upper() if fault == "truncated" else letter)

    def row(self) -> tuple:
        cost, audit = cheapest("".join(self.letters))
        gaps = 0 if self.first is None else self.turn - self.first + 1 - self.distinct
        return self.conv_id, gaps, *self.faults.values(), self.illegal, cost, audit


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, len(batch), 1024):
            yield from zip(*[column.to_pylist() for column in batch.slice(at, 1024).columns])


def _batches(rows: Iterator[tuple], schema: str, most: int = 1024, most_chars: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Rows as batches of bounded size; the last column holds the long texts."""
    fields = [field.split() for field in schema.split(", ")]
    kinds = pa.schema([(name, pa.int64() if kind == "long" else pa.string()) for name, kind in fields])
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += len(row[-1] or "")
        if len(held) == most or chars > most_chars:
            yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*held), kinds)], schema=kinds)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*held), kinds)], schema=kinds)


def _planned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        own = None
        for conv_id, turn, letter, fault in _rows(batches):
            if own is None or own.conv_id != conv_id:
                if own is not None:
                    yield own.row()
                own = _Conversation(conv_id)
            own.add(turn, letter, fault)
        if own is not None:
            yield own.row()

    return _batches(rows(), PLAN)


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, digest) of rows (conv_id, turn, role, text)."""
    filled = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")],
    )
    return filled.withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))


def faults(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, digest, letter, fault) of ``turns``: the role's first letter and the first fault, if any."""
    initial = F.left("role", F.lit(1))
    narrow = rows.select(
        "conv_id",
        "turn",
        "role",
        "digest",
        F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("x")).alias("letter"),
        (~F.col("text").rlike(VISIBLE)).alias("blank"),
        F.col("text").rlike(UNFINISHED).alias("unfinished"),
    )
    # Blank turns are no duplicates, so they need not meet.
    same = Window.partitionBy("conv_id", "role", "digest", F.when(F.col("blank"), F.col("turn"))).orderBy("turn")
    seen = narrow.withColumn("seen", F.row_number().over(same) > 1)
    fault = F.when(F.col("blank"), "blank").when(F.col("seen"), "duplicate").when(F.col("unfinished"), "truncated")
    return seen.select("conv_id", "turn", "role", "digest", "letter", fault.alias("fault"))


def plan(marked: DataFrame) -> DataFrame:
    """One row per conversation of ``faults``: gaps in the turn numbers, rows by fault, adjacent roles that may not follow
    each other, the least cost of a repair and the letters of its edits."""
    ordered = marked.repartition("conv_id").sortWithinPartitions("conv_id", *TURN_ORDER)
    return ordered.select("conv_id", "turn", "letter", "fault").mapInArrow(_planned, PLAN)


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        letters, edit, state, place, conv_id = iter(""), None, START, 0, None

        def insertions() -> Iterator[tuple]:
            """The turns put in here; ends with the edit of the next given turn, if there is one."""
            nonlocal state, place, edit
            for edit in letters:
                if edit != "I":
                    return
                state, role = FREE_ROLE[state]
                yield conv_id, place, "I", role, ""
                place += 1
            edit = None

        for conv, is_turn, role, text in _rows(batches):
            if not is_turn:
                yield from insertions()
                letters, state, place, conv_id = iter(text), START, 0, conv
                continue
            yield from insertions()
            if edit == "D":
                continue
            if edit == "R":
                state, role = FREE_ROLE[state]
            else:
                state = NEXT[state][role[0]]
            yield conv, place, edit, role, text
            place += 1
        yield from insertions()

    return _batches(rows(), TURNS)


def repaired(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """(conv_id, place, edit, role, text): the turns of ``turns`` after the edits of ``plan``, in order within a conversation.

    The rows of a conversation stay together in one partition. ``place`` counts from 0, ``edit`` is K, R or I.
    """
    nothing = [F.lit(None).cast(kind).alias(name) for name, kind in (("turn", "long"), ("role", "string"))]
    edits = planned.select("conv_id", F.lit(False).alias("is_turn"), *nothing, F.col("audit").alias("text"), F.lit(None).cast("binary").alias("digest"))
    both = edits.unionByName(rows.withColumn("is_turn", F.lit(True)))
    ordered = both.repartition("conv_id").sortWithinPartitions("conv_id", "is_turn", *TURN_ORDER)
    return ordered.select("conv_id", "is_turn", "role", "text").mapInArrow(_repaired, TURNS)


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        own, digest = None, None
        for conv_id, place, _, role, text in _rows(batches):
            if place == 0:
                if digest is not None:
                    yield own, digest.hexdigest()
                own, digest = conv_id, hashlib.sha256()
            digest.update(f"{chr(10) if place else ''}{role}:{text}".encode())
        if digest is not None:
            yield own, digest.hexdigest()

    return _batches(rows(), "conv_id long, repaired_sha256 string")


def digests(conversations: DataFrame, ids: DataFrame) -> DataFrame:
    """The plan and a digest of the repaired ``role:text`` lines for every conversation in ``ids`` (conv_id), also those
    without rows."""
    rows = turns(conversations)
    planned = materialize(plan(faults(rows)), "repairs")
    lines = repaired(rows, planned).mapInArrow(_digested, "conv_id long, repaired_sha256 string")
    found = planned.join(lines.withColumnRenamed("conv_id", "own"), F.col("conv_id").eqNullSafe(F.col("own")), "left").drop("own")
    wanted = ids.select(F.col("conv_id").cast("long").alias("wanted")).distinct()
    every = wanted.join(found, F.col("wanted").eqNullSafe(F.col("conv_id")), "left").drop("conv_id")
    counts = ("gaps", *FAULTS, "illegal", "cost")
    return every.select(
        F.col("wanted").alias("conv_id"),
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) of which a hash of id and turn drops, empties, cuts, repeats or misnames some.

    NULL is one space, in roles, texts and the hashed ``conv_id:turn``. crc32 of that, modulo 20: 0 drops the row, 1 empties
    its text, 2 takes the ends of sentences out of it, 3 repeats the row, 4 makes its role user.
    """
    space = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    kind = F.crc32(F.concat(space["conv_id"], F.lit(":"), space["turn"]).cast("binary")) % 20
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        space["role"].alias("role"),
        space["text"].alias("text"),
        kind.alias("kind"),
    ).where("kind <> 0")
    hit = rows.select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, F.lit(""))
        .when(F.col("kind") == 2, F.regexp_replace("text", SENTENCE_END, ""))
        .otherwise(F.col("text"))
        .alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    )
    return hit.drop("copy")
