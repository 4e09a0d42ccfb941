"""Random list texts and numbers against slow, plain readings of the rules."""

import json
import random
import re

from pyspark.sql import functions as F

from refrain.functions import (
    array_literal,
    lenient_double,
    lenient_int,
    list_elements,
    list_kind,
    strict_number,
)
from refrain.functions.text import WIDE_SPACE

SPACES = " \t\n\x0b\f\r"
N = 6000


def texts(pieces, seed, longest):
    rng = random.Random(seed)
    made = {"".join(rng.choice(pieces) for _ in range(rng.randint(0, longest))) for _ in range(N)}
    return sorted(made)


def evaluate(spark, values, *expressions):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    out = df.select("x", *[e.alias(f"c{i}") for i, e in enumerate(expressions)])
    return {r[0]: tuple(r)[1:] for r in out.collect()}


def read_json_list(text):
    if text == "":
        return "empty", []

    def refuse(name):
        raise ValueError(name)

    try:
        value = json.loads(text.replace("'", '"'), parse_constant=refuse)
    except ValueError:
        return "raw", [text]
    if isinstance(value, list) and all(isinstance(v, str) for v in value):
        return "list", value
    return "drop", None


def test_list_texts(spark):
    pieces = ["'", '"', "'a'", '"b"', ",", ", ", "[", "]", "[", "]", " ", "\\", "\\n", "1",
              "null", "x", "{", "}", ":", "\t", "true", "-", "0", "é"]
    values = texts(pieces, 1, 9)
    shaped = ["[" + ",".join(p) + "]" for p in
              (texts(["'a'", '"b"', "'", "null", "1.5", " ", "[]", "{'k':1}"], s, 2)[:40]
               for s in range(2, 4))]
    shaped += [f"['{a}',{b}]" for a in texts(pieces, 5, 3)[:60] for b in texts(pieces, 6, 3)[:60]]
    values = sorted(set(values + shaped))
    kind = list_kind(F.col("x"))
    got = evaluate(spark, values, kind, list_elements(F.col("x"), kind))
    wrong = {v: (got[v], read_json_list(v)) for v in values if got[v] != read_json_list(v)}
    assert not wrong, list(wrong.items())[:10]


def read_array(text):
    """Array of a literal, read one character at a time; None if malformed."""
    if text == "":
        return None
    wide = re.escape(WIDE_SPACE)
    text = re.sub(rf"\A[{wide}]*\[[{wide}]*", "{", text)
    text = re.sub(rf"[{wide}]*\][{wide}]*\Z", "}", text).replace("'", "")
    text = text.strip(SPACES)
    if len(text) < 2 or text[0] != "{" or text[-1] != "}":
        return None
    body, items = text[1:-1], []
    if not body.strip(SPACES):
        return []
    i = 0
    while True:
        while i < len(body) and body[i] in SPACES:
            i += 1
        if i < len(body) and body[i] == '"':
            i, item = i + 1, ""
            while True:
                if i >= len(body):
                    return None
                if body[i] == '"':
                    break
                if body[i] == "\\":
                    i += 1
                    if i >= len(body):
                        return None
                item += body[i]
                i += 1
            i += 1
            while i < len(body) and body[i] in SPACES:
                i += 1
            if i < len(body) and body[i] != ",":
                return None
            items.append(item)
        else:
            item, escaped = "", False
            while i < len(body) and body[i] != ",":
                if body[i] in '"{}':
                    return None
                if body[i] == "\\":
                    i, escaped = i + 1, True
                    if i >= len(body):
                        return None
                item += body[i]
                i += 1
            item = item.rstrip(SPACES)
            if not item:
                return None
            items.append(None if item.lower() == "null" and not escaped else item)
        if i >= len(body):
            return items
        i += 1


def test_array_literals(spark):
    pieces = ["'", '"', "'a'", '"b"', '"c, d"', ",", " , ", "[", "]", " ", "null", "'NULL'",
              "x", "y z", "n", "ull", "\t", "\n", "it's", "\x1f", " "]
    inner = texts(pieces, 7, 7)
    values = sorted(set(texts(pieces, 8, 6) + [f"[{v}]" for v in inner] + [f" [{v} ] " for v in inner[:2000]]))
    got = evaluate(spark, values, array_literal(F.col("x"), on_bad="null"))
    wrong = {v: (got[v][0], read_array(v)) for v in values if got[v][0] != read_array(v)}
    assert not wrong, (len(wrong), list(wrong.items())[:10])


def test_numbers(spark):
    pieces = ["0", "1", "7", "9", ".", "e", "E", "-", "+", "x", "X", "b", "o", "f", " ", " ",
              "Infinity", "inf", "NaN", "d", "_", "\n"]
    values = texts(pieces, 9, 5)
    decimal = r"(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?"

    def strict(text):
        text = text.strip(WIDE_SPACE)
        if text == "":
            return 0.0
        if re.fullmatch(rf"[+-]?(?:Infinity|{decimal})", text):
            return float(text)
        if re.fullmatch(r"0(?:[xX][0-9a-fA-F]+|[oO][0-7]+|[bB][01]+)", text):
            return float(int(text, 0))
        return None

    def prefix(pattern, convert):
        def read(text):
            found = re.match(pattern, text.lstrip(WIDE_SPACE))
            return convert(found.group()) if found else None

        return read

    integer = prefix(r"[+-]?[0-9]+", int)
    double = prefix(rf"[+-]?(?:Infinity|{decimal})", float)
    x = F.col("x")
    got = evaluate(spark, values, strict_number(x), lenient_int(x), lenient_double(x))
    wrong = {
        v: got[v] for v in values if got[v] != (strict(v), integer(v), double(v))
    }
    assert not wrong, list(wrong.items())[:10]
