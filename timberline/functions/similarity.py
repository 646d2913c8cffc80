"""Vector expressions on array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from timberline.fixed_values import LITERAL_DECIMALS


def dot(left: Column, right: Column) -> Column:
    """Dot product in double precision, summed in element order."""
    products = F.zip_with(left, right, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def norm(vector: Column) -> Column:
    return F.sqrt(dot(vector, vector))


def cosine(left: Column, right: Column) -> Column:
    """Cosine similarity; a vector of zeros is similar to nothing (0, never NaN)."""
    lengths = norm(left) * norm(right)
    return F.when(lengths == 0, F.lit(0.0)).otherwise(dot(left, right) / lengths)


def cosine_distance(left: Column, right: Column) -> Column:
    return F.lit(1.0) - cosine(left, right)


def vector_literal(vector: Column, decimals: int = LITERAL_DECIMALS) -> Column:
    """Text form ``[a,b,...]`` with a fixed number of decimals, for exchange with other stores."""
    numbers = F.transform(vector, lambda x: F.format_string(f"%.{decimals}f", x.cast("double")))
    return F.concat(F.lit("["), F.array_join(numbers, ","), F.lit("]"))


def parse_vector_literal(text: Column) -> Column:
    return F.from_json(text, "array<double>")
