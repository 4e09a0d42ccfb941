"""All-text rows to typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refrain.functions.lists import array_literal
from refrain.functions.numbers import lenient_boolean, lenient_double, lenient_int
from refrain.functions.text import empty_to_null
from refrain.schemas import (
    BOOLEAN,
    COLUMN_TYPES,
    DOUBLE,
    INTEGER,
    TEXT,
    TEXT_LIST,
    column_type,
)


def typed_column(c: Column, type_name: str, on_bad: str = "fail") -> Column:
    """A text column read as a type. Empty text is NULL whatever the type."""
    if type_name == TEXT:
        return empty_to_null(c)
    if type_name == INTEGER:
        return lenient_int(c, on_bad)
    if type_name == DOUBLE:
        return lenient_double(c)
    if type_name == BOOLEAN:
        return lenient_boolean(c)
    if type_name == TEXT_LIST:
        return array_literal(c, on_bad)
    raise ValueError(f"no reading of text as {type_name}")


def typed_projection(
    df: DataFrame, types: dict[str, str] = COLUMN_TYPES, on_bad: str = "fail"
) -> DataFrame:
    """Every column by the type its name stands for, unknown names as text.

    ``on_bad`` says what becomes of an integer out of range or a malformed
    list: ``fail`` stops the load, ``null`` stores NULL.
    """
    return df.select(
        *[
            typed_column(F.col(f"`{name}`"), column_type(name, types), on_bad).alias(name)
            for name in df.columns
        ]
    )
