"""The query of byte-level BPE."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from timberline.llm.byte_bpe import byte_pair_bytes, byte_pair_ids
from timberline.llm.registry import given, query


@query()
def op11_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    table = byte_pair_bytes(byte_pair_ids(given(spark, folder, "documents")))
    return table.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
