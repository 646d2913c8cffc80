"""Queries of the language model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from timberline.llm.language_model import language_scores
from timberline.llm.quality_queries import fold
from timberline.llm.registry import given, query


@query()
def op7_language_scores(spark: SparkSession, folder: str) -> DataFrame:
    return language_scores(given(spark, folder, "documents"), fold(F.col("doc_id"), 7) == 2)
