"""Column expressions. All are built-in Spark expressions; none is a Python UDF."""

from refrain.functions.bands import band
from refrain.functions.dates import date_parts
from refrain.functions.lists import array_literal, list_elements, list_kind
from refrain.functions.numbers import (
    lenient_boolean,
    lenient_double,
    lenient_int,
    strict_number,
)
from refrain.functions.text import (
    drop_list_marks,
    empty_to_null,
    keep_printable_ascii,
    trim_wide,
)

__all__ = [
    "array_literal",
    "band",
    "date_parts",
    "drop_list_marks",
    "empty_to_null",
    "keep_printable_ascii",
    "lenient_boolean",
    "lenient_double",
    "lenient_int",
    "list_elements",
    "list_kind",
    "strict_number",
    "trim_wide",
]
