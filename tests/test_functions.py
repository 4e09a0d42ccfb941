"""Column expressions on literal inputs."""

import math
import re

import pytest
from pyspark.sql import functions as F

from refrain.functions import (
    array_literal,
    band,
    date_parts,
    drop_list_marks,
    empty_to_null,
    keep_printable_ascii,
    lenient_boolean,
    lenient_double,
    lenient_int,
    list_elements,
    list_kind,
    strict_number,
    trim_wide,
)
from refrain.functions.lists import _BARE_START
from refrain.functions.text import WIDE_SPACE


def evaluate(spark, values, *expressions):
    """Rows of expression results, in the order of ``values``.

    The inputs sit in a real relation, so nothing is constant-folded.
    """
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, x string").repartition(2)
    out = df.select("i", *[e.alias(f"c{n}") for n, e in enumerate(expressions)])
    return [tuple(r)[1:] for r in out.orderBy("i").collect()]


def check(spark, table, expression):
    got = [r[0] for r in evaluate(spark, list(table), expression)]
    assert dict(zip(table, got)) == table


ZERO_WIDTH, NO_BREAK, BOM = chr(0x200B), chr(0x00A0), chr(0xFEFF)
ARABIC_YEAR = "".join(chr(0x0660 + d) for d in (1, 9, 2, 9))


@pytest.fixture()
def X(spark):
    return F.col("x")


def test_date_parts(spark, X):
    table = {
        "2003-11-30": ("2003", "11", "30"),
        "08/10/1984": ("1984", "10", "08"),
        "1876": ("1876", "", ""),
        "no date": ("", "", ""),
        "7/9/1951": ("1951", "9", "7"),
        "1929-01": ("", "", ""),
        "2020-99-99": ("2020", "99", "99"),
        " 1929 ": ("1929", "", ""),
        f"19{ZERO_WIDTH}29": ("1929", "", ""),
        "1929-01-12T00": ("", "", ""),
        "0/0/0000": ("0000", "0", "0"),
        "1/2/29": ("", "", ""),
        "1929\n": ("1929", "", ""),
        ARABIC_YEAR: ("", "", ""),
        "": ("", "", ""),
        None: ("", "", ""),
    }
    got = evaluate(spark, list(table), *date_parts(X))
    assert dict(zip(table, got)) == table


def test_strict_number(spark, X):
    nan = None
    table = {
        "": 0.0, "  ": 0.0, None: nan, "1.0d": nan, "1f": nan, "inf": nan,
        "1_000": nan, "NaN": nan, "abc": nan, "0x10": 16.0, "0XfF": 255.0,
        "0x": nan, "-0x10": nan, "0o17": 15.0, "0b101": 5.0, "0b2": nan,
        "0x00000000000000000001": 1.0, "0xffffffffffffffff": float(2**64 - 1),
        "0x1ffffffffffffffff": float(2**65 - 1), "0x" + "9" * 40: float(int("9" * 40, 16)),
        "0x80000000000004" + "0" * 30 + "1": float(int("80000000000004" + "0" * 30 + "1", 16)),
        "0o" + "7" * 50: float(int("7" * 50, 8)), "0b1" + "01" * 70: float(int("1" + "01" * 70, 2)),
        "0x1" + "0" * 300: math.inf, "0x0": 0.0, "-1": -1.0, "+1": 1.0,
        "Infinity": math.inf, "-Infinity": -math.inf, "infinity": nan,
        "1e5": 1e5, "1e": nan, ".5": 0.5, "5.": 5.0, ".": nan, NO_BREAK + "5": 5.0,
        "5" + BOM + "\n": 5.0, "1 2": nan, "007": 7.0, "1e999": math.inf,
    }
    check(spark, table, strict_number(X))


def test_band(spark, X):
    table = {
        "0.4": "Low", "0.5": "Medium", "0.6": "Medium", "0.8": "High",
        "abc": "", None: "", "": "", "  ": "Low", "1.0d": "", "inf": "",
        "NaN": "", "0x10": "", "-1": "Low", "-Infinity": "Low", "Infinity": "",
        "1.01": "", ".5": "Medium", "0.60000001": "High", "1": "High", "0": "Low",
    }
    check(spark, table, band(X, strict_number(X)))


def test_band_strict_lower(spark, X):
    table = {
        "-1": "", "-Infinity": "", "0": "Low", "-0": "Low", "0.5": "Medium", "abc": "",
        "0.49": "Low", "1": "High", "2": "",
    }
    check(spark, table, band(X, strict_number(X), strict_lower=True))


def test_lenient_int(spark, X):
    table = {
        "12abc": 12, "12.7": 12, "-3.9": -3, "7e4": 7, "0.5x": 0, ".5": None,
        "abc": None, "": None, None: None, " 12": 12, NO_BREAK + "12": 12, "+5": 5,
        "0x1A": 0, "01": 1, "2147483647": 2147483647, "-2147483648": -2147483648,
        "- 1": None, "12345.0": 12345,
    }
    check(spark, table, lenient_int(X))


@pytest.mark.parametrize("text", ["3000000000", "-2147483649", "9" * 60])
def test_lenient_int_out_of_range(spark, X, text):
    with pytest.raises(Exception, match="integer out of range"):
        evaluate(spark, [text], lenient_int(X))
    assert evaluate(spark, [text], lenient_int(X, on_bad="null")) == [(None,)]


def test_lenient_double(spark, X):
    table = {
        "12abc": 12.0, "7e4": 70000.0, "0.5x": 0.5, "1e": 1.0, "5.": 5.0,
        ".5": 0.5, "-Infinity": -math.inf, "abc": None, "": None, None: None,
        "-.5e-1z": -0.05, "0x1A": 0.0, "  3": 3.0, ".": None,
    }
    check(spark, table, lenient_double(X))


def test_lenient_boolean(spark, X):
    table = {
        "true": True, "TRUE": True, "1": True, "False": False, "0": False,
        " true": None, "yes": None, "": None, None: None, "1.0": None,
    }
    check(spark, table, lenient_boolean(X))


LISTS = {
    "['a','b']": ("list", ["a", "b"]),
    "[]": ("list", []),
    " [ ' a ' , '' ] ": ("list", [" a ", ""]),
    '["a\\u0041\\n", "b"]': ("list", ["aA\n", "b"]),
    "['a, b', 'c']": ("list", ["a, b", "c"]),
    "['a\\'b']": ("list", ['a"b']),
    "abc": ("raw", ["abc"]),
    "['a'": ("raw", ["['a'"]),
    "['a'] junk": ("raw", ["['a'] junk"]),
    "['a'] ['b']": ("raw", ["['a'] ['b']"]),
    "[\"o'x\"]": ("raw", ["[\"o'x\"]"]),
    "['a',]": ("raw", ["['a',]"]),
    "['a\tb']": ("raw", ["['a\tb']"]),
    "['a\\x']": ("raw", ["['a\\x']"]),
    "1],[2": ("raw", ["1],[2"]),
    '1},{"v":2': ("raw", ['1},{"v":2']),
    "01": ("raw", ["01"]),
    "NaN": ("raw", ["NaN"]),
    "  ": ("raw", ["  "]),
    NO_BREAK + "['a']": ("raw", [NO_BREAK + "['a']"]),
    "5": ("drop", None),
    "-1.5e3": ("drop", None),
    "1e999": ("drop", None),
    " " + "9" * 60 + "\n": ("drop", None),
    "[" + "9" * 60 + "]": ("drop", None),
    "'a' ": ("drop", None),
    "-": ("raw", ["-"]),
    "1 2": ("raw", ["1 2"]),
    " [true, -0.5e+3,\n'a', null] ": ("drop", None),
    "[01]": ("raw", ["[01]"]),
    "[1.]": ("raw", ["[1.]"]),
    "['a' 'b']": ("raw", ["['a' 'b']"]),
    "[,]": ("raw", ["[,]"]),
    "tea": ("raw", ["tea"]),
    "{'a':[{'b':null}]}": ("drop", None),
    "{'a':1": ("raw", ["{'a':1"]),
    "null": ("drop", None),
    "'text'": ("drop", None),
    "[1,2]": ("drop", None),
    "['a',1]": ("drop", None),
    "['a',null]": ("drop", None),
    "[['a']]": ("drop", None),
    "{'a':1}": ("drop", None),
    "{'a':1,'a':2}": ("drop", None),
    "": ("empty", []),
    None: ("empty", []),
}


def test_list_text_for_prepare(spark, X):
    kind = list_kind(X)
    got = evaluate(spark, list(LISTS), kind, list_elements(X, kind))
    assert dict(zip(LISTS, got)) == LISTS


def test_list_text_of_any_length(spark, X):
    n = 200_000
    text = "[" + ", ".join(["'ab'"] * n) + "]"
    kind = list_kind(X)
    (row,) = evaluate(
        spark,
        [text],
        kind,
        F.size(list_elements(X, kind)),
        F.size(array_literal(X)),
    )
    assert row == ("list", n, n)
    quoted = text.replace("'", '"')
    assert evaluate(spark, [quoted], F.size(array_literal(X))) == [(n,)]


def test_array_literal(spark, X):
    table = {
        "['a', 'b c']": ["a", "b c"],
        "[]": [],
        " [ ] ": [],
        "[\"children's music\", 'rock']": ["childrens music", "rock"],
        "['a, b']": ["a", "b"],
        "[\"a, b\", 'c']": ["a, b", "c"],
        "['null','x']": [None, "x"],
        '["null"]': ["null"],
        "  [ 'a' ]  ": ["a"],
        "{a,b}": ["a", "b"],
        "['a' , 'b c ', d]": ["a", "b c", "d"],
        "['a\tb',\t'c']": ["a\tb", "c"],
        "['it's', 'x']": ["its", "x"],
        "['NULL', 'nullable', 'n'ull']": [None, "nullable", None],
        "[null]": [None],
        "['\"a, b\"' , ' c d ']": ["a, b", "c d"],
        '["[x]", y]': ["[x]", "y"],
        '[" a ", ""]': [" a ", ""],
        "['a\x1fb', c]": ["a\x1fb", "c"],
        "['a\nb' , \n c]": ["a\nb", "c"],
        "[' a']": ["a"],
        '["a\\"b", c\\,d]': ['a"b', "c,d"],
        "[[a]]": ["[a]"],
        "": None,
        None: None,
    }
    check(spark, table, array_literal(X))


MALFORMED = ["abc", "[a", "a]", "[a,,b]", "[,]", "['', 'a']", "[' ', a]", "'[a]'", "[a \"b\"]", "['a',]", '["a]', '["a"b]', "[{a}]", "  ", "["]


@pytest.mark.parametrize("text", MALFORMED)
def test_array_literal_malformed(spark, X, text):
    with pytest.raises(Exception, match="malformed list text"):
        evaluate(spark, [text], array_literal(X))


def test_array_literal_malformed_as_null(spark, X):
    got = evaluate(spark, MALFORMED, array_literal(X, on_bad="null"))
    assert got == [(None,)] * len(MALFORMED)


def test_text(spark, X):
    assert evaluate(spark, [WIDE_SPACE + "a b" + WIDE_SPACE], trim_wide(X)) == [("a b",)]
    assert evaluate(spark, [ZERO_WIDTH + "a"], trim_wide(X)) == [(ZERO_WIDTH + "a",)]
    check(spark, {"a" + chr(0xE9) + "\tb" + ZERO_WIDTH + "c ~": "abc ~"}, keep_printable_ascii(X))
    check(spark, {"['a', \"b\"]": "a, b", None: None}, drop_list_marks(X))
    check(spark, {"": None, " ": " ", None: None}, empty_to_null(X))
    assert len(WIDE_SPACE) == len(set(WIDE_SPACE)) == 25


def test_texts_without_a_number_are_not_cast(spark):
    number = lenient_int(F.col("x"), "null")
    assert "nullif" in str(number).lower()
    check(spark, {"x": None, "": None, "7x": 7}, number)


def test_bare_list_elements_take_all_but_marks_and_wide_spaces():
    start = re.compile(f"[{_BARE_START}]".replace(r"\x{10FFFF}", chr(0x10FFFF)))
    refused = {c for c in map(chr, range(0x110000)) if not start.match(c)}
    assert refused == {*"\",{}[]\\'\x1f", *WIDE_SPACE}
