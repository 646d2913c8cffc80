"""Queries of the operators that judge single documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from timberline.llm import quality, secrets_scan, toxicity
from timberline.llm.registry import given, query


def fold(identifier: Column, folds: int) -> Column:
    """The fold of a row: crc32 of the identifier as text, modulo the number of folds."""
    return F.crc32(F.coalesce(identifier.cast("string"), F.lit("")).cast("binary")) % folds


@query()
def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = given(spark, folder, "documents")
    held_out = lambda identifier: fold(identifier, 5) == 0
    model = toxicity.fitted(docs, given(spark, folder, "labels"), held_out=held_out)
    return toxicity.scored(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query()
def op2_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets_scan.secrets(given(spark, folder, "documents"))
    is_kind = lambda kind: lambda span: span["kind"] == kind

    def listed(spans: Column) -> Column:
        return F.array_join(
            F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))),
            ",",
        )

    base = F.filter("spans", lambda span: span["kind"] != "random")
    counts = [
        F.size(F.filter("spans", is_kind(kind))).cast("long").alias(f"n_{kind}") for kind, _ in secrets_scan.KINDS
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


@query()
def op8_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_scores(given(spark, folder, "documents"))
