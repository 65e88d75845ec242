"""Defined results of the first ten operators and the pipeline on NULL ids, repeated rows, long texts, clashing names."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tiktoken.load import load_tiktoken_bpe
from tokenizers import Tokenizer

import corpus_pipeline
from salescope.llm import bpe, decontaminate, html_text, near_duplicates, neighbours, queries, substring, suffix_array
from salescope.llm import token_ids, toxicity
from salescope.sources.scratch import new_path

CLASHING = "doc_id long, text string, kept string, ids int, score string, bucket int, key string, n_words string, __repeated int"
WORDS = "[^\x20\x09-\x0d]+"
WORD_FILE, BYTE_FILE = public_tokenizers.path(queries.WORD_BPE), public_tokenizers.path(queries.BYTE_BPE)


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "kept", 7, "score", 3, "key", "words", 1) for i, t in rows], CLASHING)


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def passage(seed, n, stem="w"):
    chooser = random.Random(seed)
    return " ".join(f"{stem}{chooser.randrange(10**6)}" for _ in range(n))


SHARED = passage(1, 80)
# Repeated rows of one document, a NULL id with a text that others have, and texts without words.
EDGES = [
    (5, f"{passage(2, 30)} {SHARED} {passage(3, 30)}"),
    (5, f"{passage(2, 30)} {SHARED} {passage(3, 30)}"),
    (None, f"{SHARED} {passage(4, 9)}"),
    (None, f"{SHARED} {passage(4, 9)}"),
    (9, f"{passage(5, 20)} {SHARED}"),
    (10, None),
    (10, None),
    (11, ""),
    (12, " \n\t\x0b"),
]


@pytest.fixture(scope="module")
def long_texts():
    """Two texts above every piece size that share a passage near their ends, and one that is one long word."""
    tail = passage(6, 70)
    return [(1, f"{passage(7, 300_000)} {tail}"), (2, f"{tail} {passage(8, 300_000)}"), (3, "x" * 1_200_000)]


def words_left(rows, window):
    own = [re.findall(WORDS, t or "") for _, t in rows]
    first = {}
    for (i, _), words in zip(rows, own):
        for j in range(len(words) - window + 1):
            if i is not None:
                key = tuple(words[j : j + window])
                first[key] = min(i, first.get(key, i))
    found = []
    for (i, _), words in zip(rows, own):
        gone = set()
        for j in range(len(words) - window + 1):
            if i is not None and first[tuple(words[j : j + window])] < i:
                gone.update(range(j, j + window))
        found.append((i, len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone)))
    return collections.Counter(found)


def test_substring_edges(spark):
    found = substring.deduplicate(docs_of(spark, EDGES)).collect()
    assert collections.Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in found) == words_left(EDGES, 50)
    assert sum(r.n_removed for r in found) == 80


def test_substring_long_texts(spark, long_texts):
    found = {r.doc_id: r for r in substring.deduplicate(docs_of(spark, long_texts)).collect()}
    assert {i: (r.n_words, r.n_removed) for i, r in found.items()} == {1: (300_070, 0), 2: (300_070, 70), 3: (1, 0)}
    assert sha(found[2].kept) == sha(long_texts[1][1].split(" ", 70)[70])


def test_suffix_array_edges(spark):
    found = suffix_array.deduplicate(docs_of(spark, EDGES), keep="none", whole_characters=False).collect()
    by_id = collections.defaultdict(list)
    for r in found:
        by_id[r.doc_id].append(r)
    # Rows without an id stay as they are; repeated rows are copies of each other in full.
    assert all(r.n_removed == 0 and r.n_bytes == len(EDGES[2][1].encode()) for r in by_id[None])
    assert [r.n_removed for r in by_id[5]] == [len(EDGES[0][1])] * 2 and all(not r.kept for r in by_id[5])
    shared = len(SHARED) + 1  # and the blank before it
    assert [(r.n_removed, r.n_spans) for r in by_id[9]] == [(shared, 1)]
    assert [(r.n_bytes, r.n_removed, r.n_spans) for i in (10, 11) for r in by_id[i]] == [(0, 0, 0)] * 3


def test_suffix_array_long_texts(spark, long_texts):
    rows = long_texts[:2]
    found = {r.doc_id: r for r in suffix_array.deduplicate(docs_of(spark, rows), keep="none", whole_characters=False).collect()}
    tail = len(" ".join(long_texts[1][1].split(" ")[:70]))
    assert [found[i].n_removed for i in (1, 2)] == [tail, tail] and [found[i].n_spans for i in (1, 2)] == [1, 1]


def test_token_files_edges(spark, long_texts):
    known = Tokenizer.from_file(WORD_FILE)
    rows = EDGES + [(20, long_texts[0][1]), (21, "y" * 50_000)]
    folder = new_path(spark, "edges")
    token_ids.write_ids(docs_of(spark, rows), WORD_FILE, folder)
    found = token_ids.read_digests(spark, folder).collect()
    ordered, start, expected = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")), 0, []
    for i, text in ordered:
        ids = np.array([*known.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        expected.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(repr, ((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in found))) == sorted(map(repr, expected))
    nothing = new_path(spark, "edges")
    token_ids.write_ids(docs_of(spark, []), WORD_FILE, nothing)
    assert token_ids.read_digests(spark, nothing).count() == 0


def test_byte_bpe_edges(spark):
    known = tiktoken.Encoding("edges", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_tiktoken_bpe(BYTE_FILE), special_tokens={})
    # One cut of 80,000 letters; a text above the piece size.
    rows = EDGES + [(20, passage(12, 200_000)), (21, "ab" * 40_000)]
    found = bpe.round_trip(docs_of(spark, rows), BYTE_FILE, public_tokenizers.PATTERN).collect()
    expected = []
    for i, text in rows:
        if i == 21:
            continue
        ids = known.encode_ordinary(text or "")
        expected.append((i, len(ids), sha(",".join(map(str, ids))), sha(text or "")))
    got = [(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found]
    assert sorted(map(repr, (g for g in got if g[0] != 21))) == sorted(map(repr, expected))
    assert [g[3] for g in got if g[0] == 21] == [sha("ab" * 40_000)]


def test_toxicity_edges(spark, long_texts):
    chooser = random.Random(3)
    plain = ["".join(chooser.choice("abcdefghij") for _ in range(6)) for _ in range(200)]
    rows = [(i, " ".join(chooser.choice(plain) for _ in range(40)) + " zorkle" * (i % 4 == 0)) for i in range(1000, 1200)]
    labels = spark.createDataFrame(
        [(i, int(i % 4 == 0), "clash") for i, _ in rows] + [(None, 1, "x"), (1003, None, "x"), (1004, 0, "x")], "doc_id long, toxic int, text string"
    )
    docs = docs_of(spark, rows + EDGES + long_texts[:1])
    model = toxicity.fit(docs, labels)
    scored = toxicity.score(docs, model).collect()
    assert len(scored) == len(rows) + len(EDGES) + 1 and all(0 <= r.score <= 1 for r in scored)
    by_id = collections.defaultdict(set)
    for r in scored:
        by_id[r.doc_id].add(r.score)
    assert all(len(by_id[i]) == 1 for i in (None, 10, 11)) and by_id[10] == by_id[11]
    kept = toxicity.remove(docs, model)
    assert kept.columns == docs.columns
    assert collections.Counter(r.doc_id for r in kept.collect()) == collections.Counter(r.doc_id for r in scored if r.score < toxicity.REJECTED)


def test_decontamination_edges(spark, long_texts):
    item = passage(21, 40, "q")
    benchmark = spark.createDataFrame(
        [(1, item, "x"), (1, item, "x"), (2, None, "x"), (None, item, "x"), (3, "", "x")], "item_id long, text string, doc_id string"
    )
    rows = EDGES + [(30, f"{passage(22, 50)} {item}"), (30, f"{passage(22, 50)} {item}"), (None, item), (31, f"{long_texts[0][1]} {item}")]
    docs = docs_of(spark, rows)
    found = decontaminate.find(docs, benchmark)
    assert sorted((r.doc_id, r.item_id) for r in found.collect()) == [(30, 1), (31, 1)]
    kept = decontaminate.remove(docs, benchmark)
    assert kept.columns == docs.columns
    gone = collections.Counter(i for i, _ in rows) - collections.Counter(r.doc_id for r in kept.collect())
    assert gone[30] == 2 and gone[31] == 1 and set(gone) <= {30, 31, None}
    assert decontaminate.find(docs.where("false"), benchmark).count() == decontaminate.find(docs, benchmark.where("false")).count() == 0


def test_windows_against_brute_force(spark):
    """Items without placeholders: a document holds an item if it has 13 of its tokens in a row, or all of a shorter one."""
    chooser = random.Random(5)
    letters = ["bird", "tree", "stone", "river"]
    items = [" ".join(chooser.choice(letters) for _ in range(chooser.randint(5, 24))) for _ in range(30)]
    texts = [" ".join(chooser.choice(letters) for _ in range(chooser.randint(0, 60))) for _ in range(60)]
    for k in range(0, 60, 4):  # half of an item, or all of it, somewhere in the text
        words, part = texts[k].split(), items[k % 30].split()
        at = chooser.randint(0, len(words))
        texts[k] = " ".join(words[:at] + part[: chooser.choice([len(part), 13, 12, 7])] + words[at:])
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = decontaminate.find(docs_of(spark, list(enumerate(texts))), benchmark)

    def windows(text, size):
        words = text.split()
        return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}

    expected = set()
    for i, text in enumerate(texts):
        for j, item in enumerate(items):
            size = min(13, len(item.split()))
            if windows(text, size) & windows(item, size):
                expected.add((i, j))
    assert {(r.doc_id, r.item_id) for r in found.collect()} == expected and len(expected) > 10


def test_near_duplicate_edges(spark, long_texts):
    copy = long_texts[0][1]
    rows = EDGES + [(40, copy), (41, copy.replace(" ", "\n", 5)), (42, long_texts[1][1]), (43, EDGES[0][1].upper())]
    docs = docs_of(spark, rows)
    found = collections.Counter((r.doc_id, r.component_id, r.kept) for r in near_duplicates.find(docs, words=4).collect())
    components = {i: c for i, c, _ in found}
    assert components[5] == components[43] == 5 and components[40] == components[41] == 40 and components[42] == 42
    assert all(components[i] == i for i in (9, 10, 11, 12)) and sum(found.values()) == len(rows)
    kept = near_duplicates.remove(docs)
    assert kept.columns == docs.columns
    left = collections.Counter(r.doc_id for r in kept.collect())
    assert left[None] == 2 and left[43] == left[41] == 0 and left[40] == left[42] == left[9] == left[11] == 1


def test_many_unlike_texts_that_share_a_template(spark):
    """A template of 300 words with 100 own words each: alike, but no two linked; and the links agree with exact sets."""
    template = passage(50, 300)
    rows = [(i, f"{template} {passage(1000 + i, 100)}") for i in range(300)]
    rows += [(1000 + i, f"{template} {passage(1000 + i, 100)} end") for i in range(0, 300, 10)]
    found = {r.doc_id: r.component_id for r in near_duplicates.find(docs_of(spark, rows), words=4).collect()}
    assert found == {i: i if i < 1000 else i - 1000 for i, _ in rows}


def test_page_edges(spark):
    story = "<p>" + " ".join(["word"] * 60) + "</p>"
    long = "<html><body><div>" + story * 6000 + "</div></body></html>"
    open_tags = "<html><body>" + "<b>x " * 2000 + story + "</body></html>"
    rows = [(1, "u", story), (1, "u", story), (None, None, story), (2, "u", None), (3, "u", ""), (4, "u", long), (5, "u", open_tags)]
    pages = spark.createDataFrame([(*r, "clash", 1) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    found = html_text.extract(pages).collect()
    assert collections.Counter(r.page_id for r in found) == collections.Counter(r[0] for r in rows)
    texts = collections.defaultdict(set)
    for r in found:
        texts[r.page_id].add((r.text, r.n_chars))
    assert texts[1] == texts[None] == {(" ".join(["word"] * 60), 299)} and texts[2] == texts[3] == {("", 0)}
    assert texts[4] == {("\n".join([" ".join(["word"] * 60)] * 6000), 6000 * 300 - 1)} and "word word" in next(iter(texts[5]))[0]
    assert html_text.extract(pages.where("false")).count() == 0


def test_vector_edges(spark):
    chooser = random.Random(7)
    vectors = [(i, [chooser.uniform(-1, 1) for _ in range(8)]) for i in range(120)]
    rows = vectors + [vectors[3], vectors[50], (None, vectors[0][1]), (200, None), (201, []), (250, [float("nan")] * 8), (300, [1.0] * 4), (301, [0.5] * 4)]
    table = spark.createDataFrame([(i, v, 1, "r") for i, v in rows], "vec_id long, embedding array<double>, score int, rank string")
    found = collections.defaultdict(list)
    for r in neighbours.top_k(table, F.col("id") % 50 == 0, 5).orderBy("query_id", "rank").collect():
        found[r.query_id].append((r.score, r.vec_id))
    whole = [(i, np.floor(256 * np.array(v)).astype(int)) for i, v in rows if i is not None and v and np.isfinite(v).all()]
    for q in (0, 50, 100, 300):
        own = next(v for i, v in whole if i == q)
        scores = sorted((-int(own @ v), i) for i, v in whole if i != q and len(v) == len(own))
        assert found[q] == [(-s, i) for s, i in scores[:5]]
    assert set(found) == {0, 50, 100, 300}


def test_pipeline_on_empty_tables_and_edges(spark, tmp_path):
    for name, schema in (("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    columns = "doc_id long, text string, lang string, source string, n_chars long, key string, hash long"
    for folder, rows in (("none", []), ("some", EDGES)):
        docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), "key", 1) for i, t in rows], columns)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, docs, str(tmp_path))
            assert kept.columns == docs.columns, name
            docs = spark.createDataFrame(kept.collect(), columns)
        encoded = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
        if folder == "none":
            assert encoded == []
            continue
        # Every id that is left, rows without an id or words as they were, and the passage once among the others.
        assert {r.doc_id for r in encoded} == {5, 9, 10, 11, 12, None}
        left = collections.defaultdict(list)
        for r in docs.collect():
            left[r.doc_id].append(r.text)
        assert sorted(left[None]) == sorted(t for i, t in EDGES if i is None)
        assert left[5] == [EDGES[0][1]] and SHARED not in left[9][0]
        assert all(t in (None, "", " \n\t\x0b") for i in (10, 11, 12) for t in left[i])


def test_suffix_array_keeps_repeated_rows_once_and_copies_of_a_common_passage(spark):
    """Repeated rows are the first copy together; a passage in very many texts between ever new words goes from all others."""
    rows = EDGES + [(100 + i, f"{passage(500 + i, 8)} {SHARED} {passage(900 + i, 8)}") for i in range(2100)]
    kept = collections.defaultdict(list)
    for r in suffix_array.remove(docs_of(spark, rows)).collect():
        kept[r.doc_id].append(r.text)
    assert kept[5] == [EDGES[0][1]] * 2 and sum(map(len, kept.values())) == len(rows)
    for i in range(100, 2200):  # the last figures of the word before the passage may be common to two texts
        assert SHARED[:200] not in kept[i][0] and kept[i][0].startswith(" ".join(passage(400 + i, 8).split()[:7]))
