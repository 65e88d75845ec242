"""Periodic runs, the mixture of sources and the repair of conversations against brute force."""

import collections
import hashlib
import heapq
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from salescope.llm import mixing, queries, repair, runs

FOLDER = "/root/testdata/sf0.001"
WORDS = "[^\x20\x09-\x0d]+"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# Periodic runs ---------------------------------------------------------------------------------------------


def every_run(words, least=12):
    """All runs by comparing the words with themselves at every distance."""
    names = {w: i for i, w in enumerate(dict.fromkeys(words))}
    own, found = np.array([names[w] for w in words], dtype=np.int64), {}
    for period in range(1, len(own) // 2 + 1):
        same = np.concatenate([[False], own[:-period] == own[period:], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1])
        for start, stop in zip(edges[::2].tolist(), edges[1::2].tolist()):
            length = stop - start + period
            # A stretch with a smaller period was found with that one.
            if length >= max(least, 2 * period):
                found.setdefault((start, length), period)
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda run: (run[0], run[2]))


def kept_words(words, found):
    gone = {i for start, length, period in found for i in range(start + period, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


@pytest.mark.parametrize("least", [12, 7, 2])
def test_runs_of_words(least):
    chooser = random.Random(least)
    for _ in range(400):
        words = [chooser.randrange(chooser.choice([1, 2, 3, 9])) for _ in range(chooser.randint(0, 70))]
        if words and chooser.random() < 0.6:
            a = chooser.randrange(len(words))
            p = 1 + (len(words) - a) // chooser.randint(2, 9)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        assert runs.find_runs(words, least) == every_run(words, least)


def test_runs_of_words_that_repeat_in_every_way():
    fibonacci = ["a", "ab"]
    while len(fibonacci[-1]) < 600:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    for text in (fibonacci[-1], "a" * 500, "ab" * 250, ("a" * 30 + "b") * 12, "abc" * 40 + "abd" * 40):
        words = [ord(c) for c in text]
        assert runs.find_runs(words) == every_run(words)


def test_runs_in_documents(spark):
    chooser = random.Random(5)
    loop = " ".join(f"w{i % 17}" for i in range(100))
    rows = [(i, " ".join(chooser.choice("ab") for _ in range(chooser.randint(0, 60)))) for i in range(40)]
    # Copies of a passage far apart are no run; runs beside each other in one text; odd white space and letters.
    passage = " ".join(f"p{i}" for i in range(30))
    middle = " ".join(f"m{i}" for i in range(90))
    rows += [(100, f"{passage} {middle} {passage}"), (101, f"{middle} {loop} {middle} {loop}"), (102, "é é   " * 9 + "\x0bé\t" * 20)]
    rows += [(103, None), (104, ""), (105, " \n\t"), (106, "x" * 3000), (107, loop), (107, loop), (None, loop), (None, None)]
    docs = spark.createDataFrame([(i, t, [1], "clash", 0) for i, t in rows], "doc_id long, text string, runs array<int>, collapsed string, n_words int")
    found = runs.find(docs)
    assert found.columns == ["doc_id", "n_words", "runs", "collapsed"]
    got = collections.Counter((r.doc_id, r.n_words, tuple(map(tuple, r.runs)), r.collapsed) for r in found.collect())
    expected = collections.Counter()
    for i, text in rows:
        words = re.findall(WORDS, text or "")
        own = every_run(words)
        expected[i, len(words), tuple(own), kept_words(words, own)] += 1
    assert got == expected
    assert runs.digests(runs.find(runs.looped_tail(docs.where("false")))).count() == 0


def test_runs_in_a_text_longer_than_a_piece(spark):
    chooser = random.Random(6)
    block = [f"word{chooser.randrange(10**6)}" for _ in range(20_000)]
    words = [chooser.choice(block) for _ in range(150_000)] + block * 3 + block[:77]
    found = runs.find(spark.createDataFrame([(1, " ".join(words)), (2, "a b")], "doc_id long, text string")).collect()
    long = next(r for r in found if r.doc_id == 1)
    assert len(" ".join(words)) > 2 * runs.per_piece.__defaults__[1]
    assert [tuple(r) for r in long.runs] == [(150_000, 60_077, 20_000)] and len(long.collapsed.split()) == 170_000


def test_runs_query(spark):
    rows = queries.table(spark, FOLDER, "documents").select("doc_id", "text").collect()
    got, damaged = {r.doc_id: r for r in queries.periodic_runs(spark, FOLDER).collect()}, 0
    assert len(got) == len(rows)
    for doc_id, text in rows:
        words, h = re.findall(WORDS, text or ""), zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words, damaged = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)], damaged + 1
        own, row = every_run(words), got[doc_id]
        longest = max(own, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
        assert (row.n_runs, row.start, row.length, row.period) == (len(own), *longest)
        assert row.exponent_milli == (1000 * longest[1] // longest[2] if own else None)
        assert row.runs_sha256 == sha("".join(f"{s},{n},{p}\n" for s, n, p in own))
        assert row.collapsed_sha256 == sha(kept_words(words, own))
    assert damaged > 3


# Mixture of sources ----------------------------------------------------------------------------------------


def reshared(sizes, weights, most):
    """Targets by sharing out what is left, again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in full)
        rest = sum(weight[s] for s in order if s not in full)
        target = {s: most * sizes[s] if s in full else left * weight[s] / rest for s in order}
        above = {s for s in order if target[s] > most * sizes[s]}
        if not above:
            return target
        full |= above


@pytest.mark.parametrize("seed", range(4))
def test_mixture(spark, seed):
    chooser = random.Random(seed)
    names = [None, "", "B", "a", "é", "\U0001f600", "￿", "z"][: 3 + 2 * seed]
    rows = []
    for i in range(300):
        source = names[0] if chooser.random() < 0.4 else chooser.choice(names)
        rows.append((i, source, chooser.choice([None, "", " \t"]) if i % 11 == 0 else " ".join("w" * chooser.randint(1, 30))))
    rows += [(7, "z", "again and again")] * 3 + [(None, "z", "no id"), (None, None, None)]
    docs = spark.createDataFrame([(*r, 1.0, 2) for r in rows], "doc_id long, source string, text string, target double, size int")
    found = mixing.mix(docs, rows_per_range=20).collect()
    count = {id(r): len(re.findall(WORDS, r[2] or "")) for r in rows}
    sizes = collections.Counter()
    for r in rows:
        sizes[r[1]] += len(re.findall(WORDS, r[2] or ""))
    assert sorted(map(repr, ((r.doc_id, r.source, r["size"]) for r in found))) == sorted(map(repr, ((r[0], r[1], count[id(r)]) for r in rows)))
    wanted, taken = reshared(dict(sizes), (5, 2, 1), 3), collections.Counter()
    cut = collections.Counter()
    for r in found:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(wanted[r.source])
        assert 0 <= r.taken <= 3 * r["size"]
        taken[r.source] += r.taken
        cut[r.source] += r["size"] > 0 and r.taken % r["size"] > 0
    for source in sizes:
        assert abs(taken[source] - wanted[source]) <= 0.5 and cut[source] <= 1
    again = mixing.mix(docs.repartition(13, "size"), rows_per_range=7).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, found))


def test_mixture_of_nothing(spark):
    schema = "doc_id long, source string, text string"
    assert mixing.mix(spark.createDataFrame([], schema)).count() == 0
    blank = mixing.mix(spark.createDataFrame([(1, "a", None), (2, None, "")], schema)).collect()
    assert {(r.doc_id, r["size"], r.target, r.taken) for r in blank} == {(1, 0, 0.0, 0), (2, 0, 0.0, 0)}


def test_mixture_uses_no_python(spark):
    plan = mixing.mix(queries.table(spark, FOLDER, "documents"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


# Repair of conversations -----------------------------------------------------------------------------------

AFTER = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
FREE = {"": "u", "s": "u", "u": "a", "a": "u"}


def cheapest(letters):
    """(cost, edits) by Dijkstra over (cost, edits)."""
    best, heap = {}, [(0, "", 0, "")]
    while heap:
        cost, edits, at, state = heapq.heappop(heap)
        if (at, state) in best:
            continue
        best[at, state] = cost, edits
        ways = [(2, "I", at, FREE[state])]
        if at < len(letters):
            ways.append((3, "D", at + 1, state))
            letter = letters[at]
            more = letter.isupper()
            if letter != "-":
                ways.append((2 + more, "R", at + 1, FREE[state]))
                if letter.lower() in AFTER[state]:
                    ways.append((more, "K", at + 1, letter.lower()))
        for extra, edit, to, then in ways:
            heapq.heappush(heap, (cost + extra, edits + edit, to, then))
    return min(best[len(letters), state] for state in ("", "a") if (len(letters), state) in best)


def test_cheapest_edits():
    chooser = random.Random(9)
    for size in [0, 1, 2] * 20 + [5, 9] * 150 + [70, 200] * 8:
        letters = "".join(chooser.choice("uauauasUAS-x") for _ in range(size))
        assert repair.cheapest(letters) == cheapest(letters)


def test_long_conversations_take_linear_time():
    chooser = random.Random(10)
    letters = "".join(chooser.choice("uauauauauaU-x") for _ in range(30_000))
    cost, edits = repair.cheapest(letters)
    assert len(edits) - edits.count("I") == len(letters)
    state, spent, at = "", 0, 0
    for edit in edits:
        letter = "" if edit == "I" else letters[at]
        at += edit != "I"
        spent += {"I": 2, "D": 3, "R": 2, "K": 0}[edit] + (edit in "KR" and letter.isupper())
        state = state if edit == "D" else FREE[state] if edit in "IR" else AFTER[state][letter.lower()]
    assert spent == cost and state == "a"


def expected_repair(rows):
    """The figures of one conversation's rows (turn, role, text), by the definition."""
    seen, letters, counts, turns = set(), "", collections.Counter(), {t for t, _, _ in rows if t is not None}
    for _, role, text in rows:
        letter = role[:1] if role[:1] in ("s", "u", "a") else "x"
        visible = re.sub("[\x20\x09-\x0d]", "", text)
        fault = "blank" if not visible else "duplicate" if (role, text) in seen else "truncated" if visible[-1] not in ".!?" else None
        seen.add((role, text))
        counts[fault] += 1
        letters += "-" if fault in ("blank", "duplicate") else letter.upper() if fault else letter
    initials = [role[:1] for _, role, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    cost, audit = cheapest(letters)
    state, left, lines = "", list(rows), []
    for edit in audit:
        _, role, text = (None, None, "") if edit == "I" else left.pop(0)
        if edit == "D":
            continue
        state = role[0] if edit == "K" else FREE[state]
        lines.append((role if edit == "K" else {"u": "user", "a": "assistant"}[state]) + ":" + text)
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, sha("\n".join(lines))


def figures(row):
    return row.gaps, row.blank, row.duplicate, row.truncated, row.illegal, row.cost, row.audit, row.repaired_sha256


def test_repair_of_conversations(spark):
    chooser = random.Random(11)
    rows, own = [], {}
    for conv_id in [None, *range(120)]:
        turns = sorted(chooser.sample(range(40), chooser.randint(1, 12)))
        own[conv_id] = [
            (t, chooser.choice(["user", "assistant"] * 4 + ["system", "tool", "", "User"]), chooser.choice(["A.", "B!", "C? \n", "cut", "", " \t", "é", "x. "]))
            for t in turns
        ]
        rows += [(conv_id, *r) for r in own[conv_id]]
    own[500], own[501] = [(None, "", ""), (3, "user", "Q."), (3, "user", "Q.")], [(None, "user", "long " * 50_000)]
    rows += [(500, None, None, None), (500, 3, "user", "Q."), (500, 3, "user", "Q."), (501, None, "user", "long " * 50_000)]
    chooser.shuffle(rows)
    table = spark.createDataFrame([(*r, "clash", 1) for r in rows], "conv_id long, turn long, role string, text string, audit string, place int")
    found = {r.conv_id: figures(r) for r in repair.digests(table, table).collect()}
    assert found == {conv_id: expected_repair(r) for conv_id, r in own.items()}
    lines = repair.turns(table)
    kept = repair.repaired(lines, repair.plan(repair.faults(lines))).groupBy("conv_id").agg(F.concat_ws("", F.transform(F.sort_array(F.collect_list(F.struct("place", F.left("role", F.lit(1)).alias("r")))), lambda x: x["r"])).alias("roles"))
    assert all(re.fullmatch("(s?(ua)+)?", r.roles) for r in kept.collect())
    empty = table.where("false")
    assert repair.digests(empty, empty).count() == 0


def test_repair_query(spark):
    own = collections.defaultdict(list)
    rows = queries.table(spark, FOLDER, "conversations").select("conv_id", "turn", "role", "text").collect()
    for conv_id, turn, role, text in sorted(rows, key=lambda r: (r.conv_id, r.turn)):
        role, text, kind = role or " ", " " if text is None else text, zlib.crc32(f"{conv_id}:{turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        own[conv_id] += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    found = {r.conv_id: figures(r) for r in queries.conversation_repair(spark, FOLDER).collect()}
    assert found == {conv_id: expected_repair(r) for conv_id, r in own.items()}
