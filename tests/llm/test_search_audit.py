"""Byte-level BPE, the filter audit and lexical search against plain versions."""

import itertools
import math
import random
import re

import duckdb
import public_tokenizers
import pytest
from pyspark.sql import functions as F
import tiktoken

from timberline.llm import lexical_search
from timberline.llm.audit_queries import op12_filter_audit
from timberline.llm.byte_bpe import Merges, Splitter, _ranks, byte_pair_bytes, byte_pair_ids, splitting
from timberline.llm.filter_audit import PackedCounters, filter_audit
from timberline.llm.lexical_search import PrefixTree, ranked_documents, terms_of
from timberline.llm.registry import SQL
from timberline.llm.token_queries import op11_byte_bpe

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=_ranks(VOCABULARY), special_tokens={}
    )


@pytest.fixture(scope="module")
def own():
    merges, splitter = Merges(_ranks(VOCABULARY)), Splitter(*splitting(public_tokenizers.PATTERN))
    return lambda text: [
        one
        for block in splitter.matches(text)
        for match in block
        for one in merges.encode(match.encode().decode("latin-1"))
    ]


def any_texts():
    generator = random.Random(4)
    signs = "aabcdeeeilnorstuAB  \n\t.,'01é漢字ñ😀՘́\x00\x1c\x85​﻿\U00010940"
    for _ in range(1500):
        yield "".join(generator.choices(signs, k=generator.randrange(60)))
    for _ in range(300):
        codes = [generator.choice([generator.randrange(0xD800), generator.randrange(0xE000, 0x110000)]) for _ in range(40)]
        yield "".join(map(chr, codes))
    for word, times in itertools.product(["a", "ab", "the", "é", " ", "\n", "=-", "01", "漢"], (1, 2, 7, 63, 1000)):
        yield word * times + generator.choice(signs)


def test_merges_like_the_library(own, library):
    for text in any_texts():
        assert own(text) == library.encode_ordinary(text), text


def test_long_match_takes_linear_time(own, library):
    text = "abcdefgh" * 20_000
    assert own(text) == library.encode_ordinary(text)
    assert len(own("q" * 300_000)) > 1000


def test_unreachable_tokens_are_found_only_whole():
    """``abc`` has no pair that merges into it, so only the whole match gives it."""
    ranks = {bytes([value]): value for value in range(256)} | {b"bc": 256, b"ab": 257, b"abc": 258, b"abcd": 259}
    merges, library = Merges(ranks), tiktoken.Encoding("x", pat_str=".+", mergeable_ranks=ranks, special_tokens={})
    for size in range(1, 8):
        for letters in itertools.product("abcd", repeat=size):
            text = "".join(letters)
            assert merges.encode(text) == library.encode_ordinary(text), text


def test_byte_pairs_of_tables(spark, library):
    texts = [None, "", " ", "a  b\r\n", "\x00", "naïve 漢字 😀" * 3, "x" * 5000, "a  b\r\n"]
    rows = [(k % 6 if k else None, text, "y") for k, text in enumerate(texts)]
    table = byte_pair_bytes(byte_pair_ids(spark.createDataFrame(rows, "doc_id string, text string, ids string")))
    assert table.columns == ["doc_id", "ids", "decoded"]
    got = sorted((r.doc_id or "", tuple(r.ids), bytes(r.decoded)) for r in table.collect())
    expected = [("" if key is None else str(key), tuple(library.encode_ordinary(t or "")), (t or "").encode()) for key, t, _ in rows]
    assert got == sorted(expected)
    empty = byte_pair_bytes(byte_pair_ids(spark.createDataFrame([], "doc_id bigint, text string")))
    assert empty.collect() == []


def test_byte_pair_query(spark, given, library):
    import hashlib

    texts = {r.doc_id: r.text or "" for r in given("documents").collect()}
    got = op11_byte_bpe(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == len(texts)
    for row in got:
        ids = library.encode_ordinary(texts[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()


def duck(sql, **tables):
    connection = duckdb.connect()
    for name, table in tables.items():
        connection.register(name, table.toPandas())
    return connection.execute(sql)


AUDIT = "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley".split()


def plain_audit(rows, labels):
    """The audit by its definition, one order and one row after the other."""
    good = {key for key, quality, _ in labels if quality == 1 and key is not None}
    toxic = {key for key, _, mark in labels if mark == 1 and key is not None}
    least = {}
    for key, text, _ in rows:
        if key is not None:
            least[text or ""] = min(key, least.get(text or "", key))
    fails = []
    for key, text, _ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        own = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            "D": bool(re.search("[#$%&*|]", text)),
            "E": key is not None and least[text] < key,
        }
        fails.append({name for name, failed in own.items() if failed})
    found = {}
    for part in {source or "" for _, _, source in rows}:
        for order in map("".join, itertools.permutations("ABCDE")):
            for step, name in enumerate(order, 1):
                counts = dict.fromkeys(AUDIT[3:], 0)
                for (key, _, source), failed in zip(rows, fails):
                    if (source or "") != part:
                        continue
                    gone, here = bool(failed & set(order[: step - 1])), name in failed
                    counts["kept"] += not gone and not here
                    counts["removed"] += here and not gone
                    counts["redundant"] += here and gone
                    counts["unique_fails"] += failed == {name}
                    counts["good_lost"] += here and not gone and key in good
                    counts["toxic_lost"] += here and not gone and key in toxic
                found[part, order, step] = counts
    for part, order, step in found:
        name = order[step - 1]
        found[part, order, step]["shapley"] = sum(
            counts["removed"] for (p, o, s), counts in found.items() if p == part and o[s - 1] == name
        )
    return {(*key, *counts.values()) for key, counts in found.items()}


def test_audit_like_plain(spark):
    generator = random.Random(5)
    pool = ["", None, "A b", "x " * 300, "a#b", " ".join(map(str, range(250))), " ".join(map(str, range(210))) + " $ ABCDEFGHIJKLMNOPQRSTUVWXYZABC"]
    rows = [
        (generator.choice([None, *range(25)]), generator.choice(pool), generator.choice(["a", "b", None, ""]))
        for _ in range(60)
    ]
    labels = [(generator.choice([None, *range(25)]), generator.choice([0, 1, None]), generator.choice([0, 1, None])) for _ in range(25)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumn("n", F.lit("x"))
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").withColumn("part", F.lit("x"))
    got = filter_audit(docs.withColumn("mask", F.lit(1)), marks)
    assert got.columns == AUDIT
    expected = plain_audit(rows, labels)
    assert {tuple(row) for row in got.collect()} == expected
    assert set(duck(SQL["op12_filter_audit"], documents=docs, labels=marks).fetchall()) == expected


def test_audit_of_one_hot_text(spark):
    """A text that nearly all rows share, and rows without identifiers, in one part."""
    docs = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.lit("same text").alias("text"), F.lit("s").alias("source")
    )
    labels = spark.createDataFrame([(4, 1, 1), (4, 1, 1)], "doc_id bigint, quality int, toxic int")
    row = filter_audit(docs, labels).where("filter_order = 'EABCD' AND step = 1").first()
    assert (row.kept, row.removed, row.good_lost, row.toxic_lost, row.unique_fails) == (1001, 1999, 1, 1, 0)


def test_packed_counters_do_not_run_over():
    counters = PackedCounters("ABCDE", rows=7)
    everything = counters.packed(31, True, True)
    for _, _, values in counters.unpacked(7 * everything):
        assert set(values) <= {0, 7}
    assert sum(values[1] for _, _, values in counters.unpacked(7 * everything)) == 7 * 120


def test_audit_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, source string")
    assert filter_audit(docs, spark.createDataFrame([], "doc_id bigint, quality int, toxic int")).collect() == []


def test_audit_query_has_all_steps(spark, given):
    assert op12_filter_audit(spark, "/root/testdata/sf0.001").count() == 600 * given("documents").select("source").distinct().count()


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain_ranking(docs, items, limit=10):
    own = [(key, TERM.findall((text or "").translate(LOWER))) for key, text in docs]
    own = [(key, terms) for key, terms in own if terms]
    total = sum(len(terms) for _, terms in own)
    df = {}
    for _, terms in own:
        for term in set(terms):
            df[term] = df.get(term, 0) + 1
    found = []
    for item, text in items:
        scored = []
        for key, terms in own:
            m = 10 + 90 * len(terms) * len(own) // total
            score = 0
            for term in set(TERM.findall((text or "").translate(LOWER))) & df.keys():
                tf = terms.count(term)
                weight = math.floor(1000 * math.log((2 * len(own) + 2) / (2 * df[term] + 1)))
                score += weight * (1_000_000_000 * tf // (1000 * tf + 8 * m))
            if score > 0:
                scored.append((-score, key is None, key))
        key_order = sorted(scored, key=lambda row: (row[0], row[1], row[2] if row[2] is not None else 0))
        found += [(item, rank, key, -score) for rank, (score, _, key) in enumerate(key_order[:limit], 1)]
    return sorted(found, key=str)


@pytest.mark.parametrize("matrix_bytes", [lexical_search.MATRIX_BYTES, 1])
def test_ranking_like_plain(spark, monkeypatch, matrix_bytes):
    """With one tree per batch, and with trees of 64 rows; in blocks of seven items."""
    monkeypatch.setattr(lexical_search, "MATRIX_BYTES", matrix_bytes)
    monkeypatch.setattr(lexical_search, "BLOCK_ITEMS", 7)
    generator = random.Random(6)
    words = [f"w{k}" for k in range(60)] + ["É", "é", "漢字", "x9"]
    weights = [1 / (k + 1) for k in range(len(words))]
    text = lambda most: " ".join(generator.choices(words, weights, k=generator.randrange(most)))
    docs = [(k, text(50)) for k in range(400)] + [(None, "w50 w51"), (5, "w50 w51"), (5, "w50 w51"), (7, None), (8, ""), (9, "..!")]
    docs += [(1000 - k, "copy of w40 w41 W42") for k in range(30)] + [(2000, "w3 " * 70_000)]
    items = [(k, text(30)) for k in range(17)] + [(3, "w40-w41 w42"), (3, "w40-w41 w42"), (50, None), (51, "nowhere"), (None, "W50")]
    documents = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("score", F.lit(1))
    wanted = spark.createDataFrame(items, "item_id bigint, text string").withColumn("doc_id", F.lit(1))
    table = ranked_documents(documents.repartition(3), wanted)
    assert table.columns == ["item_id", "rank", "doc_id", "score"]
    got = sorted((tuple(row) for row in table.collect()), key=str)
    assert got == plain_ranking(docs, items)


def test_search_cuts_branches_off():
    """Where rare terms decide, most leaves are never scored."""
    import numpy as np

    generator = np.random.default_rng(1)
    paths = [np.unique(np.concatenate([generator.integers(0, 20, 6), generator.integers(20, 2000, 3)])) for _ in range(3000)]
    tree = PrefixTree(paths, [np.ones(len(path), np.int64) for path in paths], [100] * 3000, list(range(3000)), 10)
    looked_at = []
    scores = tree.scores
    tree.scores = lambda rows, at, weights: looked_at.append(len(rows)) or scores(rows, at, weights)
    best = lexical_search.Best(10)
    tree.search(paths[7], np.where(paths[7] < 20, 10, 5000), best)
    assert best.rows[0][2] == 7
    assert sum(looked_at) < 1500


def test_ranking_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    some = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "a")], "item_id bigint, text string")
    assert ranked_documents(none, items).collect() == []
    assert ranked_documents(some, items.where("false")).collect() == []
    assert [tuple(row) for row in ranked_documents(some, items).collect()] == [(1, 1, 1, 287 * (10**9 // 1800))]


def test_terms():
    assert [term.decode() for term in terms_of("Ab-É1\x00z\u0085y [x]")] == ["ab", "É1", "z\u0085y", "x"]
    assert terms_of(None) == []
