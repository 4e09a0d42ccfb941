"""Banding of a score into labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Band labels and limits.
LOW, MEDIUM, HIGH = "Low", "Medium", "High"
LOW_BELOW, MEDIUM_UP_TO, HIGH_UP_TO = 0.5, 0.6, 1.0


def band_number(n: Column, strict_lower: bool = False) -> Column:
    """Label of a number; blank for NULL, NaN and values above the top limit.

    Negative values are Low unless ``strict_lower`` asks for the written
    interval that starts at 0. NULL passes no test, and Spark sorts NaN above
    every number, so both fall through to the blank label.
    """
    valid = n >= 0 if strict_lower else F.lit(True)
    return (
        F.when(valid & (n < LOW_BELOW), F.lit(LOW))
        .when(valid & (n <= MEDIUM_UP_TO), F.lit(MEDIUM))
        .when(valid & (n <= HIGH_UP_TO), F.lit(HIGH))
        .otherwise(F.lit(""))
    )


def band(text: Column, number: Column, strict_lower: bool = False) -> Column:
    """Label of a text score whose strict number is ``number``.

    Missing and empty text is blank although empty text reads as 0.
    """
    missing = text.isNull() | (text == "")
    return F.when(missing, F.lit("")).otherwise(band_number(number, strict_lower))
