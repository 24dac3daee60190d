"""Keep costly columns from being evaluated twice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def add_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns through a one-row generator.

    A filter on a plain projected column is pushed below the projection, which repeats the expression -
    for JSON parsing, the whole parse - once per reference. Filters do not pass a generator.
    """
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select("*", F.inline(F.array(row)))
