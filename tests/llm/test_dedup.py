"""Exact, near and passage deduplication against plain versions."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from timberline.llm import exact_dedup, minhash_dedup
from timberline.llm.components import components
from timberline.llm.exact_dedup import exact_groups
from timberline.llm.minhash_dedup import Nearness, near_components, shingle_sets
from timberline.llm.substring_dedup import Passages, without_repeated_passages
from timberline.llm.words import chunks, text_buffers, words_of
from timberline.session import folder_exists, named_folders

from tests.helpers import final_plan
from tests.llm import brute

EDGES = [
    (1, ""), (2, None), (None, "a b"), (4, "a  b"), (5, "a b"), (5, "a b"), (7, " \t\n\v\f\r"), (8, "ab"),
    (None, None), (9, "é ü"), (9, "éü other"), (10, "x" * 300_000), (11, "a b"), (12, "a\u001fb"),
]


def docs(spark, rows):
    """Rows of (doc_id, text) with columns whose names clash with those of operators."""
    more = [(*row, "kept", 1, "fp") for row in rows]
    return spark.createDataFrame(more, "doc_id bigint, text string, kept string, n int, _key string")


def prose(generator, size, vocabulary=300):
    return [f"w{generator.randrange(vocabulary)}" for _ in range(size)]


def variants(seed):
    """Near copies, long common passages and unrelated texts."""
    generator = random.Random(seed)
    rows, passage = [], prose(generator, 45)
    template = prose(generator, 90)
    for _ in range(30):
        copy = list(template)
        for _ in range(generator.randrange(4)):
            copy[generator.randrange(len(copy))] = f"e{generator.randrange(50)}"
        rows.append(copy)
    for _ in range(15):
        rows.append(prose(generator, generator.randrange(10, 60)) + passage + prose(generator, generator.randrange(40)))
    for _ in range(15):
        rows.append(prose(generator, generator.randrange(1, 120)))
    rows += [passage, passage[:40], prose(generator, 4), ["one"], ["ONE"]]
    generator.shuffle(rows)
    return [(at, " ".join(row)) for at, row in enumerate(rows)]


def test_words_like_a_pattern():
    texts = ["a b", None, "", " x", "y ", "a b c", "é" * 9, "\n\n", "p" * 600_000 + " q", "last"]
    data, offsets = text_buffers(pa.array(texts))
    found = words_of(data, offsets)
    raw = data.tobytes()
    for row, text in enumerate(texts):
        own = range(found.first[row], found.first[row + 1])
        assert [raw[found.start[i] : found.end[i]].decode() for i in own] == brute.words(text)
    hashes = found.hashes()
    spelled = [raw[x:y] for x, y in zip(found.start, found.end, strict=True)]
    assert len(set(hashes.tolist())) == len(set(spelled))


def test_chunks_keep_rows_and_sizes():
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * n for n in (0, 5, 5, 30, 0, 2)]), pa.array(range(6))], names=["t", "k"])
    got = list(chunks([batch, batch.slice(0, 0), batch], "t", 10))
    assert [k for piece in got for k in piece.column("k").to_pylist()] == [*range(6), *range(6)]
    assert all(sum(map(len, p.column("t").to_pylist())) <= 12 or p.num_rows <= 2 for p in got)


def test_exact_edges(spark):
    rows = exact_groups(docs(spark, EDGES)).collect()
    assert len(rows) == len(EDGES)
    normal = lambda text: re.sub(r"[\x20\x09-\x0D]", "", text or "")
    groups = {}
    for key, text in EDGES:
        groups.setdefault(normal(text), []).append((-len(text or ""), key is None, key or 0, key))
    expected = sorted(
        (key or -1, min(groups[normal(text)])[3], len(groups[normal(text)]), hashlib.sha256(normal(text).encode()).hexdigest())
        for key, text in EDGES
    )
    assert sorted((r.doc_id or -1, r.keep_id, r.group_size, r.text_sha256) for r in rows) == expected
    assert sum(r.kept for r in rows) == len(groups)
    assert exact_groups(docs(spark, EDGES).limit(0)).count() == 0


def test_exact_keeps_one_of_a_hot_group(spark):
    table = spark.range(3000).selectExpr("id doc_id", "if(id % 3 = 0, 'same  text', concat('t', id)) text")
    rows = exact_groups(table).where("group_size > 1").collect()
    assert len(rows) == 1000 and {r.keep_id for r in rows} == {0} and sum(r.kept for r in rows) == 1


def test_near_links_classes_whose_other_values_are_all_their_own(spark):
    generator = random.Random(3)
    template = prose(generator, 240, 4000)
    rows = [(at, " ".join([*template, *(f"own{at}x{i}" for i in range(16))])) for at in range(16)]
    near = Nearness(longest_list=3, least_rare=2)
    found = {r.doc_id: r.component_id for r in near_components(docs(spark, rows), near=near).collect()}
    assert {key: root for key, (_, root) in brute.near(rows).items()} == found == dict.fromkeys(range(16), 0)


def test_near_in_a_list_whose_members_hold_text_of_their_own(spark):
    """A passage that all share makes one long list; only copies of some of them link there."""
    generator = random.Random(8)
    passage = prose(generator, 60, 5000)
    rows = [(at, " ".join(passage + prose(generator, 60, 10**6))) for at in range(60)]
    rows += [(100 + at, rows[at][1] + " more") for at in range(0, 60, 6)]
    rows += [(200 + at, " ".join([*passage, f"end{at}"])) for at in range(12)]
    near = Nearness(longest_list=3, block_classes=5, drawn_sets=3)
    got = near_components(docs(spark, rows), near=near).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.near(rows)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize(
    "near",
    [
        Nearness(),
        Nearness(longest_list=3, block_classes=4),
        Nearness(longest_list=3, block_classes=3, drawn_sets=5, broadcast_values=0),
        Nearness(longest_list=2, block_shingles=900, hot_lists=8),
    ],
)
def test_near_like_brute(spark, seed, near):
    rows = variants(seed)
    expected = brute.near(rows)
    got = near_components(docs(spark, rows), near=near).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_edges(spark):
    got = near_components(docs(spark, EDGES)).collect()
    assert len(got) == len(EDGES)
    empty = [r for r in got if r.n_shingles == 0]
    assert len(empty) == 4 and all(r.component_id == r.doc_id and r.kept for r in empty)
    both = {r.doc_id: r.component_id for r in got if r.n_shingles and r.doc_id in (None, 4, 5)}
    assert both == {None: 4, 4: 4, 5: 4}
    assert near_components(docs(spark, EDGES).limit(0)).count() == 0


def test_components_like_brute(spark):
    generator = random.Random(3)
    links = [(generator.randrange(200), generator.randrange(200)) for _ in range(150)]
    links += [(300 + i, 301 + i) for i in range(60)] + [(500, 600 + i) for i in range(80)] + [(7, 7), (None, 3)]
    table = spark.createDataFrame(links, "a bigint, b bigint")
    got = {r.node: r.root for r in components(table).collect()}
    nodes = {x for link in links for x in link if x is not None}
    expected = brute.roots(nodes, [link for link in links if None not in link])
    assert got == {node: root for node, root in expected.items() if node != root}


@pytest.mark.parametrize("rule", [Passages(), Passages(chunk_bytes=700), Passages(width=6, minimiser=2, chunk_bytes=2000)])
def test_passages_like_brute(spark, rule):
    rows = variants(5) + [(900, None), (901, ""), (902, "w1 " * 200), (903, "x" * 200_000)]
    got = without_repeated_passages(docs(spark, rows), rule=rule).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got) == sorted(brute.passages(rows, rule.width))


def test_passages_edges(spark):
    passage = " ".join(f"w{i}" for i in range(40))
    rows = [*EDGES, (20, passage), (20, passage), (None, "a " + passage.replace(" ", "\n"))]
    got = without_repeated_passages(docs(spark, rows)).collect()
    assert sorted(((r.doc_id or -1), r.n_words, r.n_removed, r.kept_text) for r in got) == sorted(
        ((key or -1), *rest) for key, *rest in brute.passages(rows)
    )
    assert without_repeated_passages(docs(spark, EDGES).limit(0)).count() == 0


def test_windows_of_one_hash_are_told_apart(monkeypatch):
    from timberline.llm import substring_dedup as module

    real = module.rolled
    monkeypatch.setattr(module, "rolled", lambda h, w, salt=0: real(h, w, salt) if salt else real(h, w) % np.uint64(3))
    hashes = np.random.default_rng(1).integers(0, 3, 200).astype(np.uint64)
    order, same = module._sorted_runs(hashes, np.arange(194), 7)
    windows = [tuple(hashes[i : i + 7].tolist()) for i in order]
    assert [bool(x) for x in same[1:]] == [a == b for a, b in zip(windows, windows[1:])]
    assert int((~same).sum()) == len(set(windows))

# --- words and pairs that earlier versions mistook


def thue_morse(length, letters="ab"):
    return "".join(letters[bin(at).count("1") % 2] for at in range(length))


def test_words_that_polynomials_modulo_two_to_the_64_confuse(spark):
    """Thue-Morse words and their complements differ in every letter."""
    one, other = thue_morse(2048), thue_morse(2048, "ba")
    rest = " ".join(f"w{k}" for k in range(34))
    rows = [(1, f"{rest} {one}"), (2, f"{rest} {other}"), (3, one), (4, other)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    removed = {r.doc_id: r.n_removed for r in without_repeated_passages(table).collect()}
    assert removed == {1: 0, 2: 0, 3: 0, 4: 0}
    assert {r.doc_id: r.component_id for r in near_components(table).collect()} == {1: 1, 2: 1, 3: 3, 4: 4}


def test_word_hashes_are_the_same_in_any_block():
    import numpy as np

    from timberline.llm import words as module

    texts = ["x" * 700_000, "b" + "x" * 300_000, "", "é ñ", *[thue_morse(n) for n in range(1, 60)]]
    whole = " ".join(texts).encode()
    alone = []
    for word in " ".join(texts).split():
        data = np.frombuffer(word.encode(), np.uint8)
        alone += module.words_of(data, np.array([0, len(data)])).hashes().tolist()
    data = np.frombuffer(whole, np.uint8)
    assert module.words_of(data, np.array([0, len(data)])).hashes().tolist() == alone
    assert len(set(alone)) == len(set(" ".join(texts).split()))


def test_near_copies_with_a_tail_that_unlike_documents_share(spark):
    """Most listed values of the long one lead to documents unlike it, and still it finds its kind."""
    generator = random.Random(12)
    word = lambda: f"w{generator.randrange(10**9)}"
    template = [word() for _ in range(240)]
    rows = [(k, " ".join([*template, f"own{k}"])) for k in range(60)]
    near = Nearness()

    def listed(text):
        data = np.frombuffer(text.encode(), np.uint8)
        return next(iter(shingle_sets(words_of(data, np.array([0, len(data)])), 5)))[: near.listed_values]

    plain = set(listed(rows[0][1]).tolist())
    tail, most = None, -1
    for _ in range(300):
        some = [word() for _ in range(36)]
        own = sum(value not in plain for value in listed(" ".join(template + some)).tolist())
        if own > most:
            tail, most = some, own
    assert most >= 5
    rows.append((1000, " ".join(template + tail)))
    rows += [(2000 + k, " ".join(tail + [word() for _ in range(300)])) for k in range(10)]
    expected = brute.near(rows)
    assert expected[1000][1] == 0
    got = near_components(spark.createDataFrame(rows, "doc_id bigint, text string"), near=Nearness(longest_list=20, least_rare=13))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == expected


def test_exact_groups_of_any_identifier_and_over_many_ranges(spark):
    """String identifiers, rows equal in all, and one text that nearly all rows share."""
    generator = random.Random(3)
    rows = [(generator.choice([None, "a", "b", f"k{n}"]), generator.choice(["same text", "sametext ", "same text", f"t {n % 40}", "", None])) for n in range(1500)]
    table = spark.createDataFrame(rows, "doc_id string, text string").repartition(3)
    got = exact_groups(table).collect()
    groups = {}
    for key, text in rows:
        normal = "".join((text or "").split())
        groups.setdefault(normal, []).append((-len(text or ""), key is None, key or ""))
    assert len(got) == len(rows) and sum(r.kept for r in got) == len(groups)
    by_digest = {hashlib.sha256(normal.encode()).hexdigest(): own for normal, own in groups.items()}
    for row in got:
        own = by_digest[row.text_sha256]
        assert row.group_size == len(own)
        assert (row.keep_id is None, row.keep_id or "") == min(own)[1:]


def test_exact_groups_meet_in_the_sort(spark):
    """Only texts that a splitter falls into are joined up afterwards; nothing else is grouped by hash."""
    rows = [(n, f"text {n % 1000}") for n in range(2000)] + [(5000 + n, "hot") for n in range(1000)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    plan = final_plan(exact_groups(table))
    assert plan.count("BroadcastHashJoin") and "SortMergeJoin" not in plan
    source = table.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"))
    splitters = exact_dedup._splitters(source, 16, 64)
    placed = exact_dedup._placed(exact_dedup._normal(source, 64), splitters, 64)
    hot = placed.where("_normal = 'hot'").groupBy("_range").count().collect()
    assert len(hot) >= 4 and max(r["count"] for r in hot) < 500
    cut = {r._normal for r in placed.where("_cut").select("_normal").distinct().collect()}
    apart = {r._normal for r in placed.groupBy("_normal").agg(F.countDistinct("_range").alias("n")).where("n > 1").collect()}
    assert apart <= cut and len(cut) <= 15


def test_near_keeps_no_sketches_and_moves_few_texts(spark, monkeypatch, tmp_path):
    random_words = random.Random(12)
    rows = [(i, " ".join(random_words.choices("abcdefghij", k=30))) for i in range(300)]
    rows += [(300 + i, text) for i, text in rows[:3]] + [(400, rows[0][1] + " x"), (401, None)]
    texts = spark.createDataFrame(rows, "doc_id bigint, text string")
    marked = minhash_dedup._perhaps_wanted
    moved = []

    def counted(some, wanted, most_marks):
        met = marked(some, wanted, most_marks)
        moved.append((met.count(), wanted.count(), met.join(wanted, ["a", "b"]).count()))
        return met

    monkeypatch.setattr(minhash_dedup, "_perhaps_wanted", counted)
    with named_folders() as folders:
        got = {r.doc_id: r.component_id for r in near_components(texts).collect()}
    assert got == {i: i for i, _ in rows} | {300: 0, 301: 1, 302: 2, 400: 0}
    left = [spark.read.parquet(path).columns for path in folders if folder_exists(spark, path)]
    assert sum("values" in columns for columns in left) == 1  # the full sets; nothing keeps sketches
    [(met, wanted, found)] = moved
    assert wanted == 2 and found >= 2 and met < 20


def test_near_with_fewer_marks_than_texts(spark):
    random_words = random.Random(13)
    rows = [(i, " ".join(random_words.choices("abcdefghij", k=30))) for i in range(400)]
    texts = spark.createDataFrame(rows, "b bigint, _text string").withColumn("a", F.xxhash64("b"))
    wanted = texts.where("b % 3 = 0").select("a", "b")
    few = minhash_dedup._perhaps_wanted(texts, wanted, 128).select("b").collect()
    assert {r.b for r in few} >= set(range(0, 400, 3))
    assert minhash_dedup._perhaps_wanted(texts, wanted.limit(0), 128).count() == 0
