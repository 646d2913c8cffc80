"""The pipeline stage by stage, and the library without this subpackage."""

import os
import re
import shutil
import subprocess
import sys

from pyspark.sql import functions as F

import corpus_pipeline
from timberline.llm.queries import QUERIES, SQL
from timberline.llm.tables import kept_rows, settled

from tests.llm import brute
from tests.llm.test_mix import check_packing

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
FOLDER = "/root/testdata/sf0.001"


def test_every_stage_works_on_what_the_one_before_kept(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "exact_dedup", "near_dedup", "mixing", "packing"]
    given = {r.doc_id: r for r in docs.collect()}

    def after(name, table):
        found = settled(stages[name](spark, table, FOLDER), f"test-{name}")
        if name != "packing":
            assert found.columns == docs.columns
            assert all(given[r.doc_id] == r for r in found.collect())
        return found

    clean = after("toxicity", docs)
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    kept = {r.doc_id for r in clean.collect()}
    assert all(key in kept for key, toxic in labels.items() if not toxic)
    single = after("exact_dedup", clean)
    normal = lambda text: re.sub(r"[\x20\x09-\x0D]", "", text or "")
    best = {}
    for key in sorted(kept, key=lambda key: (-len(given[key].text or ""), key)):
        best.setdefault(normal(given[key].text), key)
    assert sorted(r.doc_id for r in single.collect()) == sorted(best.values())
    near = after("near_dedup", single)
    expected = brute.near([(key, given[key].text) for key in best.values()])
    assert sorted(r.doc_id for r in near.collect()) == sorted(k for k, (_, root) in expected.items() if k == root)
    mixed = after("mixing", near)
    times = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert set(times) <= {r.doc_id for r in near.collect()} and max(times.values()) <= 3
    words = lambda keys: sum(len(brute.words(given[key].text)) for key in keys)
    total = words(r.doc_id for r in near.collect())
    assert abs(words(r.doc_id for r in mixed.collect()) - total) < 0.25 * total
    packed = settled(stages["packing"](spark, mixed, FOLDER), "test-packing")
    pieces = packed.groupBy("doc_id").count().collect()
    assert {r.doc_id for r in pieces} == set(times)
    rows = [(r.doc_id, r.text) for r in mixed.collect()]
    check_packing(packed, rows)
    assert corpus_pipeline.ORACLE_SQL is None


def test_rows_are_found_again_when_files_are_packed_otherwise(spark, tmp_path):
    spark.read.parquet(f"{FOLDER}/documents.parquet").repartition(6).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))

    def packed_in(files_each):
        spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 30) if files_each == 1 else "1")
        spark.conf.set("spark.sql.files.minPartitionNum", "6" if files_each == 1 else "1")

    def operator(rows, keep):
        return settled(rows.select(*keep, (F.col("doc_id") % 3 == 0).alias("kept")), "test-kept")

    try:
        packed_in(1)
        kept = kept_rows(docs, operator)
        packed_in(6)
        assert sorted(r.doc_id for r in kept.collect()) == sorted(
            r.doc_id for r in docs.collect() if r.doc_id % 3 == 0
        )
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
        spark.conf.unset("spark.sql.files.minPartitionNum")


def test_queries_are_registered_once_per_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 11))
    assert sorted(int(name[2:].split("_")[0]) for name in SQL) == [3, 4, 5, 9, 10]


def test_the_rest_works_without_this_subpackage(tmp_path):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__"))
    script = "import __spark_entry__ as e; q = e.queries(); print('left', 'full_run' in q, any(n.startswith('op') for n in q), 'pipeline' in q, set(e.oracle_sql()) <= set(q))"
    done = subprocess.run([sys.executable, "-c", script], cwd=copy, capture_output=True, text=True, timeout=120)
    assert "left True False False True" in done.stdout, done.stderr[-2000:]
