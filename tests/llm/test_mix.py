"""Mixing and packing against plain versions."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from timberline.llm.mixing import mixed_documents, source_targets
from timberline.llm.packing import Evolution, packed_documents, packed_pieces

from tests.llm import brute
from tests.llm.test_dedup import EDGES, docs


def plain_targets(sizes):
    """Shares are capped and the excess is shared again, until none is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    target, left = {}, dict(sizes)
    while left:
        rest = sum(sizes.values()) - sum(target.values())
        total = sum(weight[s] for s in left)
        over = [s for s in left if rest * weight[s] / total > 3 * sizes[s]]
        if not over:
            return target | {s: rest * weight[s] / total for s in left}
        for s in over:
            target[s] = 3 * sizes[s]
            left.pop(s)
    return target


@pytest.mark.parametrize("seed", range(4))
def test_targets_like_plain(spark, seed):
    generator = random.Random(seed)
    names = [None, "", "é", "z", *[f"s{i}" for i in range(12)]]
    sizes = {name: generator.choice([0, 1, 7, 50, 400, 9000]) for name in names}
    table = spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, source_size bigint")
    got = {r.source: r.target for r in source_targets(table).collect()}
    expected = plain_targets(sizes)
    assert got.keys() == expected.keys()
    assert all(abs(got[k] - expected[k]) < 1e-6 * max(1, expected[k]) for k in got)


def test_mix_meets_targets_and_repeats(spark):
    generator = random.Random(2)
    rows = [
        (i, " ".join(["w"] * generator.randrange(0, 60)), generator.choice(["a", "b", "b", "b", "b", "c", None]))
        for i in range(600)
    ] + [(None, "x y", None), (None, "x y", None), (7, None, "a"), (7, "", "b")]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumn("size", F.lit("x"))
    got = mixed_documents(table).collect()
    assert len(got) == len(rows)
    by_source = {}
    for r in got:
        by_source.setdefault(r.source, []).append(r)
    expected = plain_targets({s: sum(r.size for r in found) for s, found in by_source.items()})
    for source, found in by_source.items():
        assert all(abs(r.target - expected[source]) < 1e-6 for r in found)
        assert abs(sum(r.taken for r in found) - expected[source]) <= 60
        # complete epochs come before fractions: documents differ by one repeat at most
        times = {r.taken // r.size for r in found if r.size}
        assert max(times) - min(times) <= 1 and max(times) <= 3
    again = mixed_documents(table.repartition(5)).collect()
    key = lambda r: (r.doc_id or -1, r.source or "", r.size, r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))
    assert mixed_documents(table.limit(0)).count() == 0


def test_heavier_quality_is_taken_more_often(spark):
    table = spark.range(4000).selectExpr(
        "id doc_id", "if(id % 2 = 0, 'good words', '1234 5678') text", "if(id < 2000, 'a', 'b') source"
    )
    got = mixed_documents(table).withColumn("good", F.col("doc_id") % 2 == 0)
    means = {r.good: r.m for r in got.where("source = 'a'").groupBy("good").agg(F.avg("taken").alias("m")).collect()}
    assert means[True] > means[False] * 1.5


def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


TRICKY = [
    "The END. Don't stop, it's <|endoftext|> here <|ENDOFTEXT|>", "a.b,c é. ß, »., x.. y,, z., 'll. I'LL, 3. 4,",
    "a\u001cb \u0085 c d é. Σας ΟΔΟΣ. ﬁn, ., , .", "word " * 5000, "<| startoftext |> <|startoftext|>",
]


def check_packing(table, rows, limit=2048):
    got = table.collect()
    model = tokenizer()
    found = {}
    for r in got:
        found.setdefault((r.doc_id, r.piece), []).append(r)
    expected = []
    for key, text in rows:
        ids = np.array([*model.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for piece, start in enumerate(range(0, len(ids), limit)):
            cut = ids[start : start + limit]
            expected.append((key or -1, piece, start, len(cut), zlib.crc32(cut.tobytes())))
    assert sorted((r.doc_id or -1, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(expected)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        reached = 0
        for offset, length in sorted(places):
            assert offset == reached
            reached += length
        assert reached <= limit
    return len(sequences)


def test_packing_edges(spark):
    rows = [*EDGES, *enumerate(TRICKY, 100)]
    check_packing(packed_documents(docs(spark, rows)), rows)
    check_packing(packed_documents(docs(spark, rows), limit=16), rows, 16)
    assert packed_documents(docs(spark, EDGES).limit(0)).count() == 0


def test_ids_come_with_pieces(spark):
    rows = packed_documents(docs(spark, [(1, "some words here")]), with_ids=True).collect()
    assert rows[0].ids == [*tokenizer().encode("some words here", add_special_tokens=False).ids, 0]


def test_few_sequences(spark):
    generator = np.random.default_rng(4)
    lengths = np.clip(generator.lognormal(6.3, 0.8, 3000), 1, 2048).astype(int).tolist()
    table = spark.createDataFrame([(n,) for n in lengths], "length bigint")
    got = packed_pieces(table, plan=Evolution(block_items=600))
    assert got.count() == 3000
    used = got.select("sequence_id").distinct().count()
    assert used <= -(-sum(lengths) // 2048) * 1.01 + 5
    hard = spark.createDataFrame([(n,) for n in [1100] * 300 + [900] * 200 + [48] * 200 + [700] * 40], "length bigint")
    assert packed_pieces(hard).select("sequence_id").distinct().count() <= 314


def test_words_are_counted_like_the_pattern(spark):
    got = mixed_documents(docs(spark, [(i, text) for i, (_, text) in enumerate(EDGES)]), source="kept").collect()
    assert {r.doc_id: r.size for r in got} == {i: len(brute.words(text)) for i, (_, text) in enumerate(EDGES)}


def test_words_of_letters_are_encoded_in_lines():
    from tokenizers import Tokenizer

    from timberline.llm.packing import WORDS_IN_A_LINE, _Encoded, _public_vocabulary

    tokenizer = Tokenizer.from_file(_public_vocabulary("word_bpe_49k.json"))
    asked = []

    class Counting:
        model, get_vocab, get_vocab_size = tokenizer.model, tokenizer.get_vocab, tokenizer.get_vocab_size

        def encode_batch_fast(self, texts, add_special_tokens):
            asked.extend(texts)
            return tokenizer.encode_batch_fast(texts, add_special_tokens=add_special_tokens)

    random_words = random.Random(6)
    words = ["".join(random_words.choices("aeiostréß한", k=random_words.randint(1, 9))) for _ in range(1500)]
    odd = ["don't", "</w>", "a1", "a̧b", "İstanbul", "x²", "a</w>b", "<|endoftext|>"]
    words[700:700] = odd
    known = _Encoded(Counting())
    place, count = known.look_up(np.arange(len(words), dtype=np.uint64), lambda some: [words[at] for at in some])
    got = [known.ids[x : x + n].tolist() for x, n in zip(place, count, strict=True)]
    assert got == [tokenizer.encode(word, add_special_tokens=False).ids for word in words]
    assert len(asked) <= len(odd) + -(-len(words) // WORDS_IN_A_LINE)
