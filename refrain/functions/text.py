"""Text clean-up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code points of the characters that count as white space around
# a value: tab, line feed, vertical tab, form feed, carriage return, space, the
# Unicode spaces, the line and paragraph separators and the byte order mark.
WIDE_SPACE = "".join(
    map(
        chr,
        (
            *range(0x0009, 0x000E),
            0x0020,
            0x00A0,
            0x1680,
            *range(0x2000, 0x200B),
            0x2028,
            0x2029,
            0x202F,
            0x205F,
            0x3000,
            0xFEFF,
        ),
    )
)

# Fixed value: brackets and quotes removed from list values by the views.
LIST_MARKS = "[]'\""


def trim_wide(c: Column) -> Column:
    """Trim every kind of Unicode white space; plain ``trim`` only strips U+0020."""
    return F.btrim(c, F.lit(WIDE_SPACE))


def keep_printable_ascii(c: Column) -> Column:
    """Remove everything outside the printable ASCII range."""
    return F.regexp_replace(c, r"[^\x20-\x7E]+", "")


def drop_list_marks(c: Column) -> Column:
    """Remove list brackets and both kinds of quotes wherever they stand."""
    return F.translate(c, LIST_MARKS, "")


def empty_to_null(c: Column) -> Column:
    """Empty text is a missing value once data is loaded."""
    return F.nullif(c, F.lit(""))
