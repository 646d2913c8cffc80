"""Keeping costly expressions from being computed more than once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(table: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """As ``withColumns``, but conditions on the new columns are not moved below them.

    Spark pushes a filter through a projection by repeating the projected expressions in it, which
    parses every line several times and can outgrow what can be compiled. A generator that gives one
    row per row stops that.
    """
    kept = [name for name in table.columns if name not in columns]
    row = F.struct(*[value.alias(name) for name, value in columns.items()])
    return table.select(*kept, F.inline(F.array(row)))
