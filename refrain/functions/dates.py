"""Free-form release dates."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from refrain.functions.text import keep_printable_ascii

# The accepted spellings of a date.
ISO_DATE = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
DAY_FIRST_DATE = r"\A[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}\z"
YEAR_ONLY = r"\A[0-9]{4}\z"


class DateParts(NamedTuple):
    year: Column
    month: Column
    day: Column


def clean_date(c: Column) -> Column:
    """The text the spellings are matched against. Only ASCII is left, so a plain trim does."""
    return F.trim(keep_printable_ascii(F.coalesce(c, F.lit(""))))


def date_form(cleaned: Column) -> Column:
    """Which spelling a cleaned date has, NULL when it has none."""
    return (
        F.when(cleaned.rlike(ISO_DATE), F.lit("iso"))
        .when(cleaned.rlike(DAY_FIRST_DATE), F.lit("day_first"))
        .when(cleaned.rlike(YEAR_ONLY), F.lit("year"))
    )


def split_date(cleaned: Column, form: Column) -> DateParts:
    """Year, month and day text, blank where absent.

    Nothing is checked against a calendar and nothing is padded.
    """
    iso, day_first = form == "iso", form == "day_first"
    blank = F.lit("")
    return DateParts(
        year=F.when(iso, F.substring(cleaned, 1, 4))
        .when(day_first, F.substring_index(cleaned, "/", -1))
        .when(form == "year", cleaned)
        .otherwise(blank),
        month=F.when(iso, F.substring(cleaned, 6, 2))
        .when(day_first, F.split_part(cleaned, F.lit("/"), F.lit(2)))
        .otherwise(blank),
        day=F.when(iso, F.substring(cleaned, 9, 2))
        .when(day_first, F.substring_index(cleaned, "/", 1))
        .otherwise(blank),
    )


def date_parts(c: Column) -> DateParts:
    """Year, month and day of a raw date text in one expression each."""
    cleaned = clean_date(c)
    return split_date(cleaned, date_form(cleaned))
