"""Tables of search requests: defaults, parameter domains, and a checked small form."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from timberline.fixed_values import ALL_LEVELS, DEFAULT_TOP_K, LEVELS, MAX_TOP_K
from timberline.schemas import REQUESTS


def single_request(
    spark: SparkSession, text: str, top_k: int | None = None, level: str | None = None
) -> DataFrame:
    """One request as a one-row table, checked before any plan is built."""
    if not text:
        raise ValueError("the query text must not be empty")
    check_number("top_k", top_k, 1, MAX_TOP_K)
    if level not in (None, "", ALL_LEVELS, *LEVELS):
        raise ValueError(f"level must be one of {', '.join(LEVELS)} or {ALL_LEVELS}")
    return spark.createDataFrame([(1, text, level, top_k)], REQUESTS)


def check_number(name: str, value: int | None, low: int, high: int) -> None:
    """None stands for the default; zero and other values outside the domain are errors."""
    if value is not None and not low <= value <= high:
        raise ValueError(f"{name} must be between {low} and {high}")


def tidy_requests(requests: DataFrame, default_top_k: int = DEFAULT_TOP_K) -> DataFrame:
    """Fill in defaults: no level, an empty one and ALL mean no level filter."""
    columns = requests.columns
    level = F.col("level") if "level" in columns else F.lit(None).cast("string")
    top_k = F.col("top_k") if "top_k" in columns else F.lit(None).cast("int")
    return requests.withColumns(
        {
            "level": F.when(~level.isin("", ALL_LEVELS), level),
            "top_k": F.coalesce(top_k, F.lit(default_top_k)).cast("int"),
        }
    )


def accepted_requests(
    requests: DataFrame, key: str = "query_id", levels: Sequence[str] | None = None
) -> tuple[DataFrame, int]:
    """Tidy requests, repeated ones once, and the largest ``top_k`` among them.

    Refuses the whole table, with an error, if a ``top_k`` is below 1, if one key stands for different
    requests or, given ``levels``, if a level is none of them. One aggregate finds all of this.
    """
    requests = requests.dropDuplicates()
    level = F.col("level") if levels is not None else F.lit(None).cast("string")
    found = (
        requests.groupBy(key)
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.min("top_k").alias("least"),
            F.max("top_k").alias("most"),
            F.max(~level.isin(*(levels or [""]))).alias("odd"),
        )
        .agg(
            F.count_if(F.col("rows") > 1).alias("conflicts"),
            F.count_if(F.col("least") < 1).alias("numbers"),
            F.count_if("odd").alias("levels"),
            F.max("most").alias("most"),
        )
        .first()
    )
    faults = [
        f"{count} {what}"
        for count, what in (
            (found.conflicts, f"values of {key} with different requests"),
            (found.numbers, "requests with top_k below 1"),
            (found.levels, "requests with an unknown level"),
        )
        if count
    ]
    if faults:
        raise ValueError("; ".join(faults))
    return requests, found.most or 1


def request_faults() -> Column:
    """Why a request is refused, NULL when it is fine."""
    return F.coalesce(
        F.when(F.coalesce("text", F.lit("")) == "", F.lit("empty query")),
        _top_k_fault(),
        F.when(~F.col("level").isin("", ALL_LEVELS, *LEVELS), F.lit("unknown level")),
    )


def _top_k_fault() -> Column:
    return F.when(~F.col("top_k").between(1, MAX_TOP_K), F.lit("top_k out of range"))


def seed_faults() -> Column:
    """As ``request_faults`` for the seeds of a search by stored line."""
    missing = F.coalesce(F.col("seed_id") < 1, F.lit(True))
    return F.coalesce(F.when(missing, F.lit("seed_id out of range")), _top_k_fault())


def validate_requests(requests: DataFrame, faults: Column | None = None) -> DataFrame:
    """Every request with ``accepted`` and, for a refused one, the ``reason``."""
    faults = request_faults() if faults is None else faults
    return requests.withColumn("reason", faults).withColumn("accepted", F.col("reason").isNull())


def split_requests(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted requests with defaults filled in, and the refused ones with their reason."""
    checked = validate_requests(requests)
    accepted = checked.where("accepted").drop("accepted", "reason")
    return tidy_requests(accepted), checked.where("NOT accepted").drop("accepted")


def small_table(table: DataFrame, max_rows: int) -> pa.Table | None:
    """The rows of a table that has at most ``max_rows``, else None.

    ``take`` starts no more tasks than it needs to see enough rows, and never fetches more of them.
    """
    rows = table.take(max_rows + 1)
    if len(rows) > max_rows:
        return None
    return table.sparkSession.createDataFrame(rows, table.schema, verifySchema=False).toArrow()
