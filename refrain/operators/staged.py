"""Columns that are worked out once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_computed(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``df`` with more columns, each worked out once for every row.

    The optimizer writes the expression of a plain column into all expressions and
    pushed filters that use it. Columns made by a generator stay what they are, and
    filters on them stay above it. Names must be free.
    """
    made = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select("*", F.inline(F.array(made)))
