r"""List values written as text, such as ``['a', 'b']``.

Prepare and load read them differently. Prepare turns single quotes into double
quotes and reads JSON: a list of text is a *list*; other valid JSON makes the
row unusable (*drop*); anything else is kept as one *raw* id. Load removes
single quotes and reads the rules of a database array literal.

All loops in the patterns are possessive, so that a match takes linear time and
constant stack for lists of any length.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from refrain.functions.text import WIDE_SPACE, trim_wide

# The kinds of a list text.
EMPTY, LIST, RAW, DROP = "empty", "list", "raw", "drop"

# JSON grammar (RFC 8259) of an array of strings, of a scalar or an array of
# scalars, and of the start of any value.
_JSON_SPACE = r"[ \t\n\r]*+"
_JSON_STRING = (
    r'"[^"\\\x00-\x1F]*+'
    r'(?:\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4})[^"\\\x00-\x1F]*+)*+"'
)
_JSON_NUMBER = r"-?+(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?+(?:[eE][+-]?+[0-9]++)?+"
_JSON_SCALAR = rf"(?:{_JSON_STRING}|{_JSON_NUMBER}|true|false|null)"


def _json_array_of(element: str) -> str:
    item = rf"{_JSON_SPACE}{element}{_JSON_SPACE}"
    return rf"\[(?:{item}(?:,{item})*+|{_JSON_SPACE})\]"


_JSON_STRING_ARRAY = rf"\A{_JSON_SPACE}{_json_array_of(_JSON_STRING)}{_JSON_SPACE}\z"
_JSON_FLAT = (
    rf"\A{_JSON_SPACE}(?:{_JSON_SCALAR}|{_json_array_of(_JSON_SCALAR)}){_JSON_SPACE}\z"
)
_JSON_START = rf'\A{_JSON_SPACE}[\[{{"tfn0-9-]'

# Grammar of the body of a one-dimensional array literal.
_SPACES = " \t\n\x0b\f\r"
_SPACE = r"[ \t\n\x0B\f\r]"
_QUOTED = rf'{_SPACE}*+"(?:[^"\\]|\\.)*+"{_SPACE}*+'
_BARE = rf'{_SPACE}*+(?:[^",{{}}\\ \t\n\x0B\f\r]|\\.)(?:[^",{{}}\\]|\\.)*+'
_ELEMENT = rf"(?:{_QUOTED}|{_BARE})"
_ARRAY_BODY = rf"(?s)\A(?:{_SPACE}*+|{_ELEMENT}(?:,{_ELEMENT})*+)\z"
_ARRAY_PIECE = rf'(?s){_QUOTED}|(?:[^",\\]|\\.)++'

# List texts without escapes, null words, nested brackets, blank elements or
# spaces beyond ASCII, single quotes still in. Their elements are cut out by one replacement that puts
# a separator, which they must not hold, before each.
_CUT = "\x1f"
_OUTER = r"[' \t\n\x0B\f\r]*+"
# The characters of a bare element, commonest first: ranges are tried in turn, and a
# negated class tries all of them for every character. All but marks, \x1F and wide
# spaces; spaces of ASCII and single quotes may follow the first character.
_BARE_START = (
    r"\--Z^-z!#-&(-+|~\x00-\x08\x0E-\x1E\x7F-\x9F\u00A1-\u167F\u1681-\u1FFF\u200B-\u2027"
    r"\u202A-\u202E\u2030-\u205E\u2060-\u2FFF\u3001-\uFEFE\uFF00-\x{10FFFF}"
)
_PLAIN_BARE = (
    rf"(?!(?i:n'*+u'*+l'*+l){_OUTER}[,\]])"
    rf"[{_BARE_START}][{_BARE_START}' \t\n\x0B\f\r]*+"
)
_PLAIN_ELEMENT = rf'{_OUTER}(?:"[^"\\\x1F]*+"{_OUTER}|{_PLAIN_BARE})'
_PLAIN_LIST = (
    rf"\A{_SPACE}*+\[{_PLAIN_ELEMENT}(?:,{_PLAIN_ELEMENT})*+\]{_SPACE}*+\z"
)
_PLAIN_PIECE = (
    rf'(?:\A|,){_SPACE}*+(?:"([^"]*+)"|([^",]*[^", \t\n\x0B\f\r])){_SPACE}*+'
)


def _as_json(c: Column) -> Column:
    return F.replace(c, F.lit("'"), F.lit('"'))


# A JSON text with its strings, and its numbers and words, each as one character that
# JSON does not have, and the arrays and objects of them alone.
_STRING_MARK, _VALUE_MARK = "\x01", "\x02"
_JSON_WORD = rf"{_JSON_NUMBER}|true|false|null"
_NO_JSON = r"[\x00-\x08\x0B\x0C\x0E-\x1F]"
_NOT_MARKED = r"[^\x01\x02\[\]{},:]"
_MARKED = r"[\x01\x02]"
_MEMBER = rf"\x01:{_MARKED}"
_INNERMOST = (
    rf"\[(?:{_MARKED}(?:,{_MARKED})*+)?+\]"
    rf"|\{{(?:{_MEMBER}(?:,{_MEMBER})*+)?+\}}"
)

#: How often innermost arrays and objects are taken for values before the rest is
#: read character by character.
_ROUNDS = 6

# What may come next: a value; a value or ]; a key or }; a key; a colon; what follows a
# value. Anything else is a fault.
_VALUE, _FIRST, _OPEN, _KEY, _COLON, _AFTER, _FAULT = range(7)


def _next(read: Column, c: Column) -> Column:
    """One step of a push-down automaton over a marked text; ``held`` is its stack."""
    state, held = read["state"], read["held"]
    top, rest = F.right(held, F.lit(1)), F.left(held, F.length(held) - 1)
    value, first = state.isin(_VALUE, _FIRST), state.isin(_OPEN, _KEY)
    after = state == _AFTER
    closes = (c == "]") & (top == "[") & ((state == _FIRST) | after)
    closes |= (c == "}") & (top == "{") & ((state == _OPEN) | after)
    pushes = value & c.isin("[", "{")
    found = (
        F.when(closes | (value & c.isin(_STRING_MARK, _VALUE_MARK)), _AFTER)
        .when(pushes, F.when(c == "[", _FIRST).otherwise(_OPEN))
        .when(first & (c == _STRING_MARK), _COLON)
        .when((state == _COLON) & (c == ":"), _VALUE)
        .when(after & (c == ",") & (top == "["), _VALUE)
        .when(after & (c == ",") & (top == "{"), _KEY)
        .otherwise(_FAULT)
    )
    stack = F.when(pushes, F.concat(held, c)).when(closes, rest).otherwise(held)
    return F.struct(found.alias("state"), stack.alias("held"))


def _is_json(q: Column) -> Column:
    """Whether the text is exactly one JSON value, nested to any depth.

    Strings and other scalars are masked; a quote that begins none stays and is a
    fault. Innermost arrays and objects are reduced to values a few times, and what is
    nested deeper is read by an automaton with a stack, not by recursion: in time
    proportional to the text, times its depth beyond ``_ROUNDS``.
    """
    marked = F.regexp_replace(F.regexp_replace(q, _JSON_STRING, _STRING_MARK), _JSON_WORD, _VALUE_MARK)
    marked = F.regexp_replace(marked, r"[ \t\n\r]++", "")
    for _ in range(_ROUNDS):
        marked = F.regexp_replace(marked, _INNERMOST, _VALUE_MARK)
    start = F.struct(F.lit(_VALUE).alias("state"), F.lit("").alias("held"))

    def whole(text: Column) -> Column:
        end = F.aggregate(F.split(text, ""), start, lambda read, c: F.when(c == "", read).otherwise(_next(read, c)))
        return (
            F.when(text.rlike(rf"\A{_MARKED}\z"), F.lit(True))
            .when(text.rlike(_NOT_MARKED) | ~text.rlike(r"[\[{]"), F.lit(False))
            .otherwise((end["state"] == _AFTER) & (end["held"] == ""))
        )

    # The masked text is worked out once.
    return ~q.rlike(_NO_JSON) & F.get(F.transform(F.array(marked), whole), F.lit(0))


def list_kind(c: Column) -> Column:
    """``empty``, ``list``, ``raw`` or ``drop``.

    Branches are tried in order, so only the rare text that is nested or broken is
    taken apart.
    """
    q = _as_json(c)
    return (
        F.when(c.isNull() | (c == ""), F.lit(EMPTY))
        .when(q.rlike(_JSON_STRING_ARRAY), F.lit(LIST))
        .when(~q.rlike(_JSON_START), F.lit(RAW))
        .when(q.rlike(_JSON_FLAT) | _is_json(q), F.lit(DROP))
        .otherwise(F.lit(RAW))
    )


def list_elements(c: Column, kind: Column) -> Column:
    """Ids of a list text of a known kind, untrimmed; NULL for a dropped row."""
    q = _as_json(c)
    plain = F.regexp_extract_all(q, F.lit('"([^"]*+)"'), F.lit(1))
    return (
        F.when((kind == LIST) & ~F.contains(q, F.lit("\\")), plain)
        .when(kind == LIST, F.from_json(q, "array<string>"))
        .when(kind == RAW, F.array(c))
        .when(kind == EMPTY, F.array().cast("array<string>"))
    )


def _array_element(piece: Column) -> Column:
    text = F.btrim(piece, F.lit(_SPACES))
    quoted = text.startswith('"')
    inner = F.when(quoted, F.substring(text, F.lit(2), F.length(text) - 2)).otherwise(
        text
    )
    return F.when(
        quoted | (F.lower(text) != "null"),
        F.regexp_replace(inner, r"(?s)\\(.)", "$1"),
    )


def _plain_elements(body: Column) -> Column:
    cut = F.regexp_replace(body, _PLAIN_PIECE, f"{_CUT}$1$2")
    return F.split(F.substring(cut, 2, 2**31 - 1), _CUT, -1)


def array_literal(c: Column, on_bad: str = "fail") -> Column:
    """A list text as an array, by the rules of a database array literal.

    Single quotes vanish from every element and an unquoted comma always
    separates. Empty text is NULL. A text that is no array literal fails the
    query, or is NULL with ``on_bad="null"``.
    """
    text = trim_wide(c)
    bracketed = (
        (F.length(text) >= 2)
        & F.left(text, F.lit(1)).isin("[", "{")
        & F.right(text, F.lit(1)).isin("]", "}")
    )
    inner = trim_wide(F.substring(text, F.lit(2), F.length(text) - 2))
    body = F.translate(inner, "'", "")
    elements = F.transform(
        F.regexp_extract_all(body, F.lit(_ARRAY_PIECE), F.lit(0)), _array_element
    )
    if on_bad == "null":
        bad = F.lit(None).cast("array<string>")
    else:
        message = F.concat(F.lit("malformed list text: "), c)
        bad = F.raise_error(message).cast("array<string>")
    return (
        F.when(c.isNull() | (c == ""), F.lit(None).cast("array<string>"))
        .when(c.rlike(_PLAIN_LIST), _plain_elements(body))
        .when(bracketed & (F.btrim(body, F.lit(_SPACES)) == ""), F.array().cast("array<string>"))
        .when(bracketed & body.rlike(_ARRAY_BODY), elements)
        .otherwise(bad)
    )
