"""Counts taken while a job runs, without another pass over the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from refrain.functions.lists import RAW
from refrain.operators.prepare import (
    BAD_LIST,
    BAD_NUMBER,
    LONG_ROW,
    NO_NAME,
    ROW_FAULT,
    TOO_SMALL,
    optional_column,
)
from refrain.sources.csv import SHORT_ROW

REASONS = (LONG_ROW, NO_NAME, BAD_NUMBER, TOO_SMALL, BAD_LIST)


def _counts(df: DataFrame) -> list[Column]:
    reason = F.col("reject_reason")
    return [
        F.count(F.lit(1)).alias("rows"),
        F.count_if(reason.isNull()).alias("kept"),
        *[F.count_if(reason == name).alias(name) for name in REASONS],
        F.count_if(F.col("list_kind") == RAW).alias("raw_lists"),
        F.count_if(optional_column(df, ROW_FAULT) == SHORT_ROW).alias("short_rows"),
    ]


def observe_classified(df: DataFrame, observation: Observation) -> DataFrame:
    """Count classified items: all, kept, rejected by reason, raw list texts
    kept, and short rows, whose missing fields read as blank."""
    return df.observe(observation, *_counts(df))


def count_classified(df: DataFrame) -> dict[str, int]:
    """The counts of ``observe_classified``, of stored rows; reads three columns."""
    return df.agg(*_counts(df)).first().asDict()


def observe_rows(df: DataFrame, observation: Observation) -> DataFrame:
    return df.observe(observation, F.count(F.lit(1)).alias("rows"))


def rejects_by_reason(rejects: DataFrame) -> DataFrame:
    """Number of rejected rows per reason."""
    return rejects.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n_rows"))
