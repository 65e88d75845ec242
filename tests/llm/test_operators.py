"""The operators against brute force and the public tokenizers, on texts made to hit ties, repeats and edge cases."""

import base64
import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from salescope.llm import bpe, chat, decontaminate, html_text, near_duplicates, neighbours, queries, substring, suffix_array
from salescope.llm import token_ids, toxicity

DOCS = "doc_id long, text string, kept string"
ODD = [(900, None, "x"), (901, "", "x"), (902, " \n\t", "x"), (903, "a" * 3000, "x")]
WORDS = "[^\x20\x09-\x0d]+"


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def texts(spark, rows):
    return spark.createDataFrame([(i, t, "clash") for i, t, *_ in rows], DOCS)


def random_texts(seed, letters, n=40, most=30, join=""):
    chooser = random.Random(seed)
    return [(i * 7 % 101 - 20, join.join(chooser.choice(letters) for _ in range(chooser.randint(0, most)))) for i in range(n)]


def test_passages(spark):
    rows = random_texts(1, "ab", join=" ") + ODD[:3]
    words = {i: re.findall(WORDS, t or "") for i, t, *_ in rows}
    first = {}
    for i in sorted(words):
        for j in range(len(words[i]) - 5):
            first.setdefault(tuple(words[i][j : j + 6]), i)
    found = substring.deduplicate(texts(spark, rows), 6).collect()
    assert len(found) == len(rows)
    for r in found:
        own, gone = words[r.doc_id], set()
        for j in range(len(own) - 5):
            if first[tuple(own[j : j + 6])] < r.doc_id:
                gone.update(range(j, j + 6))
        kept = " ".join(w for k, w in enumerate(own) if k not in gone)
        assert (r.n_words, r.n_removed, r.kept) == (len(own), len(gone), kept)


@pytest.mark.parametrize("keep", ["first", "none"])
@pytest.mark.parametrize("most_kinds", [2000, 3])
def test_byte_strings(spark, monkeypatch, keep, most_kinds):
    monkeypatch.setattr(suffix_array, "MOST_KINDS", most_kinds)
    rows, length = random_texts(2, "abé") + [(777, "ababab")] + ODD[:3], 5
    places = collections.defaultdict(list)
    for i, t, *_ in rows:
        data = (t or "").encode()
        for j in range(len(data) - length + 1):
            places[data[j : j + length]].append((i, j))
    expected = collections.Counter()
    for i, t, *_ in rows:
        data = (t or "").encode()
        gone = bytearray(len(data))
        for j in range(len(data) - length + 1):
            same = places[data[j : j + length]]
            if len(same) > 1 if keep == "none" else min(same) < (i, j):
                gone[j : j + length] = b"\x01" * length
        kept = bytes(x for x, g in zip(data, gone) if not g)
        expected[i, len(data), sum(gone), len(re.findall(b"\x01+", bytes(gone))), kept] += 1
    found = suffix_array.deduplicate(texts(spark, rows), length, keep, whole_characters=False).collect()
    assert collections.Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found) == expected


@pytest.mark.parametrize("least", [512, 40])
def test_smallest_shingles_lose_no_link(monkeypatch, least):
    monkeypatch.setattr(near_duplicates, "LEAST", least)
    chooser = np.random.default_rng(5)
    for size in (1, 9, 40, 41, 300):
        base = np.unique(chooser.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2))
        sets = [base]
        for _ in range(60):
            kept = base[chooser.random(len(base)) > chooser.random() / 2]
            more = chooser.integers(0, 1 << 63, chooser.integers(1, 2 + size // 4), dtype=np.uint64) * np.uint64(2)
            sets.append(np.unique(np.concatenate([kept, more])))
        halves = [(s[:least] >> np.uint64(32)).astype(np.uint32) for s in sets]
        found = near_duplicates.similar_in_part(halves[0], len(base), halves[1:], np.array([len(s) for s in sets[1:]]))
        for other, hit in zip(sets[1:], found):
            linked = 100 * len(np.intersect1d(base, other)) >= 80 * len(np.union1d(base, other))
            assert hit or not linked
            assert hit == linked or max(len(base), len(other)) > least


def test_near_duplicates_close_to_the_threshold(spark, monkeypatch):
    """Texts that meet in few large buckets, at similarities on both sides of the threshold, in blocks of few."""
    monkeypatch.setattr(near_duplicates, "BLOCK", 8)
    chooser, rows = random.Random(8), []
    base = [f"w{i}" for i in range(120)]
    for i in range(90):
        copy = list(base)
        for _ in range(chooser.randint(2, 9)):
            copy[chooser.randrange(len(copy))] = f"x{chooser.randrange(10**6)}"
        rows.append((i, " ".join(copy)))
    sets = {i: {tuple(t.split()[j : j + 4]) for j in range(117)} for i, t in rows}
    label, changed = {i: i for i in sets}, True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if label[b] < label[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    label[a], changed = label[b], True
    found = {r.doc_id: r.component_id for r in near_duplicates.find(texts(spark, rows), words=4).collect()}
    assert found == label and 1 < len(set(label.values())) < len(rows)


def test_near_duplicates(spark):
    chooser, rows = random.Random(3), []
    for _ in range(15):
        base = [chooser.choice("abcdefgh") * chooser.randint(1, 3) for _ in range(chooser.randint(0, 50))]
        for _ in range(chooser.randint(1, 8)):
            copy = list(base)
            for _ in range(chooser.randint(0, 2) if copy else 0):
                copy[chooser.randrange(len(copy))] = chooser.choice("xyZ")
            rows.append((len(rows) * 7 % 509, " ".join(copy)))
    rows += [(800, "A b"), (801, "a B")] + ODD[:3]
    sets = {}
    for i, t, *_ in rows:
        words = re.findall(WORDS, (t or "").lower())
        sets[i] = {tuple(words[j : j + 4]) for j in range(max(1, len(words) - 3))} if words else set()
    label = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if label[b] < label[a] and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    label[a], changed = label[b], True
    found = near_duplicates.find(texts(spark, rows), words=4).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found} == {
        i: (len(s), label[i], label[i] == i) for i, s in sets.items()
    }
    left = near_duplicates.remove(texts(spark, rows), words=4)
    assert left.columns == ["doc_id", "text", "kept"]
    assert {r.doc_id for r in left.collect()} == {i for i in label if label[i] == i}


def test_byte_bpe_equals_the_public_library(spark):
    import tiktoken

    path = public_tokenizers.path(queries.BYTE_BPE)
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = random_texts(4, list("ab cé\n\t's'll123!? ñ日\x85\x1c"), 60, 60) + ODD
    found = bpe.round_trip(texts(spark, rows), path, public_tokenizers.PATTERN, with_ids=True).collect()
    expected = collections.Counter((i, tuple(known.encode_ordinary(t or "")), sha(t or "")) for i, t, *_ in rows)
    assert collections.Counter((r.doc_id, tuple(r.ids), r.decoded_sha256) for r in found) == expected
    assert all(r.ids_sha256 == sha(",".join(map(str, r.ids))) and r.n_tokens == len(r.ids) for r in found)


def test_token_files_equal_the_public_library(spark, tmp_path):
    from tokenizers import Tokenizer

    path = public_tokenizers.path(queries.WORD_BPE)
    known = Tokenizer.from_file(path)
    rows = {i: t for i, t, *_ in random_texts(5, list("ab cÉ,.\n's12 İ日<|") + ["<|endoftext|>", "I'LL "], 50, 50) + ODD}
    token_ids.write_ids(texts(spark, rows.items()), path, str(tmp_path / "ids"))
    found = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_ids.read_digests(spark, str(tmp_path / "ids")).collect()}
    start, expected = 0, {}
    for i in sorted(rows):
        ids = known.encode(rows[i] or "", add_special_tokens=False).ids + [1]
        expected[i] = (start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        start += len(ids)
    assert found == expected


@pytest.mark.parametrize("size", [0, 1, 1023, 1024, 1025, 3000])
@pytest.mark.parametrize("top", [1, 300, 1 << 31, 1 << 62])
def test_words_of_simple_8b_round_trip(size, top):
    values = np.random.default_rng(size + 1).integers(0, top, size=size).astype(np.uint64)
    values[::3] = 0
    if size and top == 1 << 62:
        values[0], values[-1] = np.uint64(2**64 - 1), np.uint64(1 << 60)
    assert (token_ids.decode_segment(token_ids.encode_segment(values, 1)) == values).all()


def test_chat_reads_back_control_strings(spark):
    rows = [
        (1, 0, "user", "a\\b </s> <s> [INST] \n[/INST] \\s>"), (1, 1, "assistant", "x\\"), (1, 2, "user", None), (2, 0, "user", "q"),
        (3, 0, "assistant", ""), (4, 0, "assistant", "é[INST]"), (4, 1, "assistant", "é</s>"), (None, None, None, None),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    examples = chat.expand(df)
    assert examples.where("target is not null").count() == 4
    found = {r.conv_id: r for r in chat.digests(examples).collect()}
    for conv in (1, 2, 3, 4, None):
        turns = [(r or "", t or "") for c, _, r, t in rows if c == conv]
        loss = "".join(t for r, t in turns if r == "assistant")
        r = found[conv]
        assert (r.n_turns, r.turns_sha256) == (len(turns), sha("".join(f"{a}\n{b}\n" for a, b in turns)))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss))
    assert "Python" not in chat.digests(examples)._jdf.queryExecution().toString()


def test_top_k_with_ties_and_unusable_vectors(spark):
    maker = np.random.default_rng(6)
    vectors = [(i, (maker.integers(-3, 4, size=4) / 4).tolist(), i) for i in range(700)]
    vectors += [(1000, None, 0), (1050, [], 0), (1100, [1.0, float("nan"), 0.0, 0.0], 0), (1150, [1.0, None, 0.0, 0.0], 0)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>, score int")
    data = np.floor(256 * np.array([v for _, v, _ in vectors[:700]])).astype(np.int64)
    expected = set()
    for q in range(0, 700, 50):
        scores = data @ data[q]
        order = [j for j in np.lexsort((np.arange(700), -scores)) if j != q][:5]
        expected |= {(q, k + 1, int(j), int(scores[j])) for k, j in enumerate(order)}
    assert {tuple(r) for r in neighbours.top_k(df, F.col("id") % 50 == 0).collect()} == expected


def test_groups_of_queries_know_their_worst_score():
    maker = np.random.default_rng(7)
    data, ids = maker.integers(-99, 100, size=(1500, 3)), np.arange(1500)
    search = neighbours._Search(ids, data, ids, data, 3)
    scores = data @ data.T
    np.fill_diagonal(scores, neighbours.LOWEST)
    assert (search.scores == np.sort(scores, axis=1)[:, :-4:-1]).all()
    tree = search.query_tree
    assert tree.children[0]
    for node, worst in enumerate(search.worst):
        assert worst == search.scores[tree.points_below(node), -1].min()


def test_template_windows(spark):
    item = "Tom has 5 apples and gives 3 km of apples to Ann before Tom eats 5 pears today with joy."
    changed = "So: Bob has 7 apples and gives 9 miles of apples to Eve before Bob eats 7 pears today with joy."
    docs = texts(spark, [(1, item), (2, changed), (3, changed.replace("eats 7", "eats 8")), (4, "nothing of it"), *ODD])
    bench = spark.createDataFrame([(7, item), (8, "too short"), (9, None), (None, "x")], "item_id long, text string")
    found = {(r.doc_id, r.item_id): r.n_changed for r in decontaminate.find(docs, bench).collect()}
    assert set(found) == {(1, 7), (2, 7)} and found[1, 7] == 0 and found[2, 7] > 0
    assert {r.doc_id for r in decontaminate.remove(docs, bench).collect()} == {3, 4, 900, 901, 902, 903}
    assert decontaminate.find(docs, bench.limit(0)).count() == 0


def test_verbatim_items_of_few_or_open_words(spark):
    items = ["Who directed The Dark Knight Rises?", "17 + 24 = 41", "too short", "Ann Bob Eve Tom 1 2 3", "日本の首都はどこですか。"]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    rows = [(i, f"before it, {item} and behind") for i, item in enumerate(items)]
    rows += [(10, "東京です。日本の首都はどこですか。そうです"), (11, "17 + 25 = 42, Ann Bob Eve Tim 1 2 3, short too, 日本の首都は"), *ODD]
    docs = texts(spark, rows)
    found = {(r.doc_id, r.item_id, r.n_changed) for r in decontaminate.find(docs, bench).collect()}
    assert found == {(i, i, 0) for i in range(len(items))} | {(10, 4, 0)}
    assert {r.doc_id for r in decontaminate.remove(docs, bench).collect()} == {11, 900, 901, 902, 903}


def test_a_conflict_spares_the_other_windows(spark):
    words = [f"word{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(60)]
    words[5] = words[50] = "Ann"
    often = list(words)
    often[10:50:5] = ["Ann"] * 8
    bench = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(often))], "item_id long, text string")
    one = [*words[:50], "Eve", *words[51:]]
    other = ["Eve" if w == "Ann" else w for w in often]
    other[25] = "Zoe"
    halves = ["Eve" if w == "Ann" else w for w in often[:30]] + ["Zoe" if w == "Ann" else w for w in often[30:]]
    each = [f"Name{chr(97 + i // 5)}" if w == "Ann" else w for i, w in enumerate(often)]
    docs = texts(spark, [(i, " ".join(t)) for i, t in enumerate([one, other, halves, each])])
    found = {(r.doc_id, r.item_id): (r.n_windows, r.n_changed) for r in decontaminate.find(docs, bench.where("item_id = 1")).collect()}
    assert found[0, 1] == (38, 0)
    found = {r.doc_id: r.n_changed for r in decontaminate.find(docs, bench.where("item_id = 2")).collect()}
    assert found[1] == 1 and found[2] >= 1 and 3 not in found
    assert {r.doc_id for r in decontaminate.remove(docs, bench.where("item_id = 2")).collect()} & {1, 2, 3} == {3}


def test_copies_in_other_case(spark):
    item = "Am Montag kauft der Bauer Hans auf dem Markt in Köln 12 Säcke Korn für die Straße am Rhein und 7 km Draht"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    copies = [item.lower(), item.upper(), item.title(), item.lower().replace("12", "30").replace("7 km", "9 miles")]
    docs = texts(spark, [(i, f"so: {t}") for i, t in enumerate([item, *copies])] + [(9, item.lower().replace(" der ", " die ")[:60])])
    found = {r.doc_id: r.n_changed for r in decontaminate.find(docs, bench).collect()}
    assert found == {0: 0, 1: 0, 2: 0, 3: 0, 4: 3}
    assert {r.doc_id for r in decontaminate.remove(docs, bench).collect()} == {9}


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("plain text only", "plain text only"),
        ("<div class=header>x</div><div><p>a &amp; b<p>c<br>d</div><script>alert(1)", "a & b\nc d"),
        (
            "<body><header><h1>Site</h1></header><div id='sidebar'><ul><li><a>k</a></ul></div><div class='content'><h1>T</h1>"
            "<section><p>Long paragraph one is here\n <b>with</b>\n<i>words</i>.</p></section><section><p>Another one, in a "
            "section.</p></section></div><div class='comments'><p>I like it</p></div><footer>f</footer>",
            "T\nLong paragraph one is here with words.\nAnother one, in a section.",
        ),
    ],
)
def test_main_text(page, text):
    assert html_text.main_text(page) == text


def test_main_text_keeps_the_densest_part_beside_article_cards():
    words = " ".join(["storyword"] * 44)
    linked = f"<p>{words} <a href='/x'>twenty letters here</a></p>"
    story = f"<div><p>{words}</p>{linked}<p>{words}</p>{linked}{linked}</div>"
    card = f"<article><p>{' '.join(['teaser'] * 40)}</p></article>"
    assert html_text.main_text(f"<body>{story}{card}</body>").count("storyword") == 5 * 44
    assert html_text.main_text(f"<body>{story.replace('</div>', card + '</div>')}</body>").count("storyword") == 5 * 44
    # An article with nearly all of the text still stands for what holds it.
    page = f"<body><div><article><p>{words}</p></article><div><a href='/y'>more of it</a></div></div></body>"
    assert html_text.main_text(page) == words


@pytest.mark.parametrize(
    "wrapper", ["content-sidebar-wrap", "has-sidebar", "no-sidebar", "with-comments", "page sidebar", "widget", "comments"]
)
@pytest.mark.parametrize("tag", ["article", "main", "div"])
def test_main_text_in_a_wrapper_named_like_an_unwanted_part(wrapper, tag):
    text = "<h1>The headline</h1></div><p>One long paragraph of the story.</p><p>Another one of the story.</p>"
    story = f"<{tag}><div class='entry-header article-header'>{text}</{tag}>"
    around = "<div class='cookie-notice'><p>We use cookies.</p></div><div class='ad-banner widget_2'>Buy it</div>"
    page = f"<body><div class='{wrapper}' id='x'>{story}{around}</div></body>"
    assert html_text.main_text(page).split("\n")[-2:] == ["One long paragraph of the story.", "Another one of the story."]
    assert "The headline" in html_text.main_text(page) or tag == "div"


def test_main_text_leaves_long_comments_out():
    comments = "<p>I like this story very much, thank you.</p>" * 20
    for story in ("<article><p>The story.</p><p>Its end.</p></article>", "<div><p>The story.</p><p>Its end.</p></div>"):
        page = f"<body>{story}<div id='comments' class='comment-list'>{comments}</div></body>"
        assert html_text.main_text(page) == "The story.\nIts end."


def test_toxicity_learns_stems_and_needs_both_labels(spark):
    chooser = random.Random(8)
    plain = ["".join(chooser.choice("abcdefghij") for _ in range(6)) for _ in range(200)]
    rows, labels = [], []
    for i in range(300):
        words = [chooser.choice(plain) for _ in range(40)]
        if i % 5 == 0:
            words[3] = "zorkle" + chooser.choice(plain)
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 5 == 0)))
    docs, known = texts(spark, rows + ODD), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(docs, known)
    scores = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    held = [i for i, _ in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    right = sum((scores[i] >= toxicity.REJECTED) == (i % 5 == 0) for i in held)
    assert right / len(held) >= 0.97 and all(0 <= s <= 1 for s in scores.values())
    empty = toxicity.fit(docs, known.where("toxic = 0"))
    assert {r.score for r in toxicity.score(docs, empty).collect()} == {0.0}


def test_empty_tables(spark):
    docs, labels = texts(spark, []), spark.createDataFrame([], "doc_id long, toxic int")
    path = public_tokenizers.path(queries.BYTE_BPE)
    assert substring.deduplicate(docs).count() == suffix_array.deduplicate(docs).count() == near_duplicates.find(docs).count() == 0
    assert bpe.round_trip(docs, path, public_tokenizers.PATTERN).count() == 0
    assert toxicity.score(docs, toxicity.fit(docs, labels)).count() == 0
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert neighbours.top_k(vectors, F.col("id") % 50 == 0).count() == 0
    assert chat.digests(chat.expand(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))).count() == 0


def clustered(seed, clusters=40, size=100, dimensions=64):
    maker = np.random.default_rng(seed)
    centres = np.repeat(maker.normal(0, 1, size=(clusters, dimensions)), size, axis=0)
    return np.floor(256 * (centres + maker.normal(0, 1 / 16, size=centres.shape))).astype(np.int64)


def test_nets_are_nested_separated_and_covering():
    points = np.unique(clustered(11, size=20), axis=0).astype(np.float64)
    net = neighbours.Net(points, len(points) // 2)
    assert net.levels == sorted(net.levels, reverse=True) and len(net.centres) > 20
    away = np.sqrt(((points[:, None] - points[net.centres]) ** 2).sum(axis=2))
    for level in sorted(set(net.levels[1:])):
        held = [i for i, highest in enumerate(net.levels) if highest >= level]
        scale = neighbours.BASE**level
        between = away[np.array(net.centres)[held]][:, held]
        assert between[~np.eye(len(held), dtype=bool)].min() > scale - 1e-6
        assert away[:, held].min(axis=1).max() <= scale + 1e-6
    tree = neighbours.CoverTree(points, 4)
    assert sorted(tree.order) == list(range(len(points)))
    for node, centre in enumerate(tree.centre):
        below = points[tree.points_below(node)]
        assert (below[0] == centre).all() and np.isclose(np.sqrt(((below - centre) ** 2).sum(axis=1)).max(), tree.radius[node])
        assert sum(tree.last[c] - tree.first[c] for c in tree.children[node]) in (0, len(below))
    again = neighbours.CoverTree.read(points[tree.order], *tree.written())
    assert sorted(zip(again.first, again.last, again.radius)) == sorted(zip(tree.first, tree.last, tree.radius))


def test_clustered_vectors_are_mostly_pruned():
    data, ids = clustered(12), np.arange(4000)
    asked = ids[::8]
    search = neighbours._Search(asked, data[asked], ids, data, 5)
    scores = data[asked] @ data.T
    scores[np.arange(len(asked)), asked] = neighbours.LOWEST
    assert (search.scores == np.sort(scores, axis=1)[:, :-6:-1]).all()
    assert search.scored < 0.3 * scores.size


def test_cells_out_of_reach_are_not_searched(spark, monkeypatch):
    """Several cells and parts: the result is exact, and most cells never see a query of another cluster."""
    monkeypatch.setattr(neighbours, "CELL_ROWS", 50)
    monkeypatch.setattr(neighbours, "PART_ROWS", 60)
    data = clustered(13, clusters=20)
    searched = []
    original = neighbours._searched
    monkeypatch.setattr(neighbours, "_searched", lambda t, q, k: searched.append(q) or original(t, q, k))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(data)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    found = {tuple(r) for r in neighbours.top_k(df, F.col("id") % 25 == 0, scale=1.0).collect()}
    expected = set()
    for q in range(0, 2000, 25):
        scores = data @ data[q]
        order = [j for j in np.lexsort((np.arange(2000), -scores)) if j != q][:5]
        expected |= {(q, k + 1, int(j), int(scores[j])) for k, j in enumerate(order)}
    assert found == expected
    home, further = (q.count() for q in searched)
    assert home == 80 and further < 0.25 * 80 * 40


def odd_words(count, seed):
    """Texts of letters, marks, numbers and special tokens in any order."""
    dice = random.Random(seed)
    parts = [*"abzABZéßÉİıªµ×÷ñçŒœǅʰας中ノ", "é", "≠", "≮", "a̸", "́", *"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~", "'s", "'ll", "'", "...", "***"]
    parts += [*" \t\n 1290²½٣", "<|endoftext|>", "<|startoftext|>", "<|", "|>", "</w>", "hello", "ISN'T", "it's", "🙂", "…"]
    return ["".join(dice.choices(parts, k=dice.randint(0, 30))) for _ in range(count)]


def test_cut_texts_get_the_ids_of_the_public_library():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    whole, cut = Tokenizer.from_file(path), token_ids.WordTokenizer(path)
    for seed in range(40):
        texts = [*odd_words(60, seed), "", None]
        ids, sizes = cut.encode(pa.array(texts, pa.string()), 1)
        wanted = [[*whole.encode(t or "", add_special_tokens=False).ids, 1] for t in texts]
        assert sizes.tolist() == [len(w) for w in wanted]
        assert ids.tolist() == [i for w in wanted for i in w]


def test_a_word_is_encoded_once_whatever_marks_stand_beside_it():
    cut, seen = token_ids.WordTokenizer(public_tokenizers.path("word_bpe_49k.json")), []
    make = cut.store.make
    cut.store.make = lambda strings: seen.extend(strings) or make(strings)
    cut.encode(pa.array(['straße Straße*** (straße) "straße" straße#straße straße... ***straße']), 1)
    assert seen.count("straße".encode()) == 1 and sum("stra".encode() in s for s in seen) == 1


def test_words_without_an_end_token_are_counted_by_the_slow_way():
    cut = token_ids.WordTokenizer(public_tokenizers.path("word_bpe_49k.json"))
    wanted = [x.tolist() for x in cut._letters(["hello", "unbelievablyso", "a"])]
    cut.last[:] = False
    assert [x.tolist() for x in cut._letters(["hello", "unbelievablyso", "a"])] == wanted
    assert [len(x) for x in cut._letters([])] == [0, 0]


def test_narrow_and_wide_numbers_have_the_same_widths():
    numbers = np.array([0, 1, 2, 3, 255, 256, 65535], dtype=np.uint64)
    wide = token_ids.widths(np.append(numbers, np.uint64(1 << 40)))
    assert token_ids.widths(numbers).tolist() == wide[:-1].tolist() == [int(n).bit_length() for n in numbers]
