"""From documents to packed sequences: five stages, each on what the one before it kept.

Every stage is written as Parquet to the shared folder and read again as the next one's documents. The
tables that a stage makes on its way are removed when the next one begins, since by then its result
is written.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from timberline.llm import toxicity
from timberline.llm.exact_dedup import exact_groups
from timberline.llm.minhash_dedup import near_components
from timberline.llm.mixing import mixed_documents
from timberline.llm.packing import packed_documents
from timberline.llm.quality_queries import fold
from timberline.llm.registry import given
from timberline.llm.tables import kept_rows, with_rows

from timberline.session import named_folders, release_shuffles, remove_folder, shared_folder

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Inner tables of the stage that ran last, by application.
_inner: dict[str, list[str]] = {}


def tidying(stage: Stage) -> Stage:
    """Removes the inner tables and shuffle files of the stage before, but nothing that the documents need."""

    @wraps(stage)
    def tidied(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        held = _inner.pop(spark.sparkContext.applicationId, [])
        files = docs.inputFiles() if held else []
        in_use = [path for path in held if any(f"{path.rstrip('/')}/".split(":", 1)[-1] in file for file in files)]
        for path in held:
            if not in_use:
                remove_folder(spark, path)
        release_shuffles(spark)
        with named_folders() as folders:
            result = stage(spark, docs, sf_dir)
        _inner[spark.sparkContext.applicationId] = (held if in_use else []) + folders
        return result

    return tidied


@tidying
def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject; it learns from labels outside fold 0 of 5."""
    model = toxicity.fitted(
        given(spark, sf_dir, "documents"),
        given(spark, sf_dir, "labels"),
        held_out=lambda identifier: fold(identifier, 5) == 0,
    )
    return toxicity.accepted(docs.select(*COLUMNS), model)


@tidying
def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return kept_rows(docs.select(*COLUMNS), exact_groups)


@tidying
def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates."""
    return kept_rows(docs.select(*COLUMNS), near_components)


@tidying
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    rows = with_rows(docs.select(*COLUMNS))
    taken = mixed_documents(rows, keep=("_row",)).where("taken > 0")
    copies = F.expr("taken div size")
    times = taken.select("_row", F.explode(F.sequence(F.lit(1).cast("long"), copies)).alias("_time"))
    return rows.join(times, "_row").select(*COLUMNS)


@tidying
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return packed_documents(docs)


STAGES = [
    ("toxicity", clean),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("mixing", mixed),
    ("packing", packed),
]

# The first stage is a trained model and the last one a genetic search, so SQL cannot express the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies all stages to the documents table."""
    docs = given(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = shared_folder(spark, f"stage-{name}")
        result = stage(spark, docs, sf_dir)
        result.write.parquet(path)
        docs = spark.read.schema(result.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
