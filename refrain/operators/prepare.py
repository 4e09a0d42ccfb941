"""Preparing raw items and pruning entities.

All functions are stateless column work on all-text rows, so they take batch
and streaming DataFrames alike. The one stage boundary is ``entity_ids``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refrain.functions.bands import band
from refrain.functions.dates import clean_date, date_form, split_date
from refrain.functions.lists import DROP, list_elements, list_kind
from refrain.functions.numbers import strict_number
from refrain.functions.text import trim_wide
from refrain.operators.bloom import probable
from refrain.operators.joins import salted_join
from refrain.operators.staged import with_computed
from refrain.schemas import MIN_DURATION_MS, free_name


@dataclass(frozen=True)
class ItemColumns:
    """Names of the raw item columns the steps read."""

    name: str = "name"
    duration: str = "duration_ms"
    ids: str = "id_artists"
    date: str = "release_date"
    score: str = "danceability"


ITEM = ItemColumns()

# Columns added by prepare.
YEAR, MONTH, DAY = "release_year", "release_month", "release_day"
LEVEL = "danceability_level"

# Reasons for which an item is rejected, in the order they are tested.
LONG_ROW, NO_NAME, BAD_NUMBER, TOO_SMALL, BAD_LIST = (
    "long_row",
    "no_name",
    "bad_number",
    "too_small",
    "bad_list",
)


# Column in which a reader says what is wrong with the shape of a row.
ROW_FAULT = "row_fault"


def optional_column(df: DataFrame, name: str) -> Column:
    """A column that a dataset may lack; it then reads as blank."""
    return F.col(name) if name in df.columns else F.lit("")


def has_text(c: Column) -> Column:
    """Not missing and not blank."""
    return F.coalesce(trim_wide(c), F.lit("")) != ""


def at_least(c: Column, minimum: float) -> Column:
    """Text that spells a number of at least ``minimum``; the limit itself passes."""
    return strict_number(c) >= F.lit(float(minimum))


def required_text(df: DataFrame, column: str) -> DataFrame:
    return df.filter(has_text(F.col(column)))


def minimum_number(df: DataFrame, column: str, minimum: float) -> DataFrame:
    return df.filter(at_least(F.col(column), minimum))


def usable_list(df: DataFrame, column: str) -> DataFrame:
    """Drop rows whose list text is valid JSON but no list of texts."""
    return df.filter(list_kind(optional_column(df, column)) != DROP)


def with_date_parts(df: DataFrame, column: str = ITEM.date) -> DataFrame:
    """Append year, month and day text; columns of these names are replaced."""
    # The helper columns keep the clean-up and the matching to one evaluation.
    date, form = (free_name(n, [*df.columns, YEAR, MONTH, DAY]) for n in ("date", "form"))
    staged = df.withColumn(date, clean_date(optional_column(df, column)))
    staged = staged.withColumn(form, date_form(F.col(date)))
    parts = split_date(F.col(date), F.col(form))
    added = {YEAR: parts.year, MONTH: parts.month, DAY: parts.day}
    return staged.withColumns(added).drop(date, form)


def with_band(
    df: DataFrame,
    column: str = ITEM.score,
    into: str = LEVEL,
    strict_lower: bool = False,
) -> DataFrame:
    """Append the label of a text score."""
    score = optional_column(df, column)
    number = free_name("number", [*df.columns, into])
    staged = df.withColumn(number, strict_number(score))
    label = band(score, F.col(number), strict_lower)
    return staged.withColumn(into, label).drop(number)


def classify_items(
    df: DataFrame,
    min_duration: float = MIN_DURATION_MS,
    columns: ItemColumns = ITEM,
) -> DataFrame:
    """All rows with ``reject_reason``, NULL for a kept one, and ``list_kind``.

    The tests are made in order and the list is only looked at in rows that
    passed the others; ``list_kind`` is NULL elsewhere. A row that the reader found
    too long (``row_fault``) is rejected first.
    """
    names = list(df.columns)
    number, failed = (free_name(n, [*names, "reject_reason", "list_kind"]) for n in ("number", "failed"))
    value = F.col(number)
    fault = (
        F.when(optional_column(df, ROW_FAULT) == LONG_ROW, F.lit(LONG_ROW))
        .when(~has_text(F.col(columns.name)), F.lit(NO_NAME))
        .when(value.isNull(), F.lit(BAD_NUMBER))
        .when(value < F.lit(float(min_duration)), F.lit(TOO_SMALL))
    )
    # Each step is worked out once, whatever is asked of the result.
    df = with_computed(df.drop("list_kind", "reject_reason"), {number: strict_number(F.col(columns.duration))})
    df = with_computed(df, {failed: fault})
    kind = F.when(F.col(failed).isNull(), list_kind(optional_column(df, columns.ids)))
    df = with_computed(df, {"list_kind": kind})
    bad_list = F.when(F.col("list_kind") == DROP, F.lit(BAD_LIST))
    return df.withColumn("reject_reason", F.coalesce(F.col(failed), bad_list)).drop(number, failed)


def append_item_columns(df: DataFrame, columns: ItemColumns = ITEM) -> DataFrame:
    """The four columns prepare adds to kept items."""
    return df.transform(with_date_parts, columns.date).transform(
        with_band, columns.score
    )


def prepare_items(
    df: DataFrame,
    min_duration: float = MIN_DURATION_MS,
    columns: ItemColumns = ITEM,
) -> DataFrame:
    """Kept items with every input column as it was and four columns added."""
    kept = (
        df.transform(required_text, columns.name)
        .transform(minimum_number, columns.duration, min_duration)
        .transform(usable_list, columns.ids)
    )
    return append_item_columns(kept, columns)


def rejected_items(
    df: DataFrame,
    min_duration: float = MIN_DURATION_MS,
    columns: ItemColumns = ITEM,
) -> DataFrame:
    """The rows ``prepare_items`` leaves out, each with its ``reject_reason``."""
    classified = classify_items(df, min_duration, columns).drop("list_kind")
    return classified.filter(F.col("reject_reason").isNotNull())


def exploded_ids(df: DataFrame, column: str = ITEM.ids, distinct: bool = False) -> DataFrame:
    """One row per non-blank id of each list text, trimmed, with repeats.

    A ``list_kind`` that ``classify_items`` has left is used, not found anew.
    ``distinct`` takes each different list text once, before it is parsed.
    """
    text = optional_column(df, column)
    known = "list_kind" in df.columns
    texts = df.select(text.alias("ids"), *([F.col("list_kind").alias("kind")] if known else []))
    if distinct:
        texts = texts.distinct()
    if not known:
        texts = with_computed(texts, {"kind": list_kind(F.col("ids"))})
    elements = list_elements(F.col("ids"), F.col("kind"))
    ids = texts.select(F.explode(elements).alias("id"))
    return ids.select(trim_wide(F.col("id")).alias("id")).filter(F.col("id") != "")


def entity_ids(df: DataFrame, column: str = ITEM.ids) -> DataFrame:
    """Distinct ids the items refer to.

    Items of one entity mostly have the same list: equal texts are merged, within
    each task and then over all, and each is parsed once; then equal ids are merged.
    """
    return exploded_ids(df, column, distinct=True).distinct()


def prune_entities(
    entities: DataFrame, ids: DataFrame, key: str = "id", sieve: DataFrame | None = None
) -> DataFrame:
    """Entities whose id is among ``ids``, unchanged, repeated rows included.

    ``ids`` has one column; its values may repeat. The entity id is not trimmed. A
    ``sieve``, the ``bloom_filter`` of the ids, lets only probable entities into the join.
    """
    asked = entities
    if sieve is not None:
        # Through a computed key the exact join cannot be moved below the filter.
        exact = free_name("key", entities.columns)
        asked = with_computed(probable(entities, key, sieve), {exact: F.col(f"`{key}`")})
        key = exact
    kept = salted_join(asked, ids.toDF(key), key, "left_semi")
    return kept.select(*[F.col(f"`{c}`") for c in entities.columns])
