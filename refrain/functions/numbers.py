"""Text to number and boolean.

Two different readings exist on purpose. The strict one looks at the whole
text and is used when items are filtered and banded; the lenient ones take the
longest numeric prefix and are used when text is loaded into typed columns. So
``7e4`` passes a minimum of 60000 and is later loaded into an integer as 7.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from refrain.functions.text import WIDE_SPACE, trim_wide

# The accepted spellings of a number.
_DECIMAL = r"(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?"
_WHOLE_DECIMAL = rf"\A[+-]?(?:Infinity|{_DECIMAL})\z"
_LEADING_SPACE = rf"\A[{WIDE_SPACE}]*+"
_INT_PREFIX = rf"{_LEADING_SPACE}([+-]?[0-9]+)"
_DOUBLE_PREFIX = rf"{_LEADING_SPACE}([+-]?(?:Infinity|{_DECIMAL}))"

# Integer literals with a prefix letter: base, bits of a digit and the
# digits that 60 bits hold.
_RADIX_LITERAL = r"\A0(?:[xX][0-9a-fA-F]+|[oO][0-7]+|[bB][01]+)\z"
_RADIX = {"x": (16, 4, 15), "o": (8, 3, 20), "b": (2, 1, 60)}


def _radix_number(text: Column) -> Column:
    """The nearest double of a literal of any length.

    The first 60 bits are taken as a whole number whose last bit is set if any
    later one is; it has more bits than a double, so rounding it once rounds the
    whole literal rightly.
    """
    letter = F.lower(F.substring(text, 2, 1))
    digits = F.ltrim(F.substring(text, 3, 2**31 - 1), F.lit("0"))
    value = F.lit(None).cast("double")
    for name, (radix, bits, width) in _RADIX.items():
        rest = F.substring(digits, width + 1, 2**31 - 1)
        head = F.call_function("conv", F.left(digits, F.lit(width)), F.lit(radix), F.lit(10))
        sticky = F.when(rest.rlike("[^0]"), F.lit(1)).otherwise(F.lit(0)).cast("long")
        whole = head.try_cast("long").bitwiseOR(sticky).cast("double")
        scale = F.pow(F.lit(2.0), (bits * F.length(rest)).cast("double"))
        value = F.when(letter == name, whole * scale).otherwise(value)
    return F.when(digits == "", F.lit(0.0)).otherwise(value)


def strict_number(c: Column) -> Column:
    """The number the whole text spells, NULL if it spells none.

    Blank text is 0, and hexadecimal, octal and binary literals of any length are
    read. The guards matter: a bare cast also accepts ``1.0d`` or ``inf`` and
    refuses blanks.
    """
    text = trim_wide(c)
    return (
        F.when(text.rlike(_WHOLE_DECIMAL), text.try_cast("double"))
        .when(text == "", F.lit(0.0))
        .when(text.rlike(_RADIX_LITERAL), _radix_number(text))
    )


def lenient_int(c: Column, on_bad: str = "fail") -> Column:
    """Leading whole number of a text as a 32-bit integer, NULL if there is none.

    A number that does not fit fails the query, or is NULL with ``on_bad="null"``.
    """
    # Casting empty text would give NULL too, but each failed cast is costly.
    value = F.nullif(F.regexp_extract(c, _INT_PREFIX, 1), F.lit("")).try_cast("int")
    if on_bad == "null":
        return value
    # Only a text without a value is looked at again.
    message = F.concat(F.lit("integer out of range: "), c)
    misfit = F.when(c.rlike(_INT_PREFIX), F.raise_error(message).cast("int"))
    return F.coalesce(value, misfit)


def lenient_double(c: Column) -> Column:
    """Longest numeric prefix of a text as a double, NULL if there is none."""
    # Casting empty text would work too, but each failed cast is costly.
    prefix = F.nullif(F.regexp_extract(c, _DOUBLE_PREFIX, 1), F.lit(""))
    return prefix.try_cast("double")


def lenient_boolean(c: Column) -> Column:
    """``true``/``1`` and ``false``/``0``, words in any case; anything else is NULL."""
    word = F.lower(c)
    return F.when(word.isin("true", "1"), F.lit(True)).when(
        word.isin("false", "0"), F.lit(False)
    )
