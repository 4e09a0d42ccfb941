"""Lists to rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refrain.functions.text import drop_list_marks, empty_to_null


def unnest_list(
    df: DataFrame, column: str, into: str, outer: bool = False
) -> DataFrame:
    """One row per element of a list column, which is replaced by ``into``.

    The list is read as the views read it: joined with commas, freed of brackets
    and quotes, split at commas and trimmed of spaces. So an element that holds
    a comma gives two rows and NULL elements give none. With ``outer`` a row
    whose list is NULL or empty is kept once with a NULL element.
    """
    text = drop_list_marks(F.array_join(F.col(column), ","))
    # An empty text has no elements, while split would make one of it.
    parts = F.split(empty_to_null(text), ",", -1)
    explode = F.explode_outer if outer else F.explode
    others = [F.col(f"`{name}`") for name in df.columns if name != column]
    rows = df.select(*others, explode(parts).alias(into))
    return rows.withColumn(into, F.trim(F.col(into)))
