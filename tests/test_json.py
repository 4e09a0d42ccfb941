"""List texts that are JSON of any depth, against a strict parser."""

import json
import random
import sys

from refrain.functions import list_kind
from pyspark.sql import functions as F


def is_json(text):
    def refuse(_):
        raise ValueError

    try:
        json.loads(text, parse_constant=refuse, parse_int=str, parse_float=str)
    except ValueError:
        return False
    return True


def plain_kind(text):
    if not text:
        return "empty"
    text = text.replace("'", '"')
    if not is_json(text):
        return "raw"
    value = json.loads(text)
    return "list" if isinstance(value, list) and all(isinstance(x, str) for x in value) else "drop"


def kinds(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, t string").repartition(4)
    return [r.k for r in df.select("n", list_kind(F.col("t")).alias("k")).orderBy("n").collect()]


def test_any_depth_and_any_number(spark):
    texts = []
    for depth in (1, 2, 5, 6, 7, 8, 50, 500, 5_000):
        texts += [
            "[" * depth + "]" * depth,
            "[" * depth + "1" * 1_500 + "]" * depth,
            '{"a":' * depth + "null" + "}" * depth,
            '[{"a":' * depth + "['x', {}]" + ', "a": 1 }]' * depth,
        ]
    assert kinds(spark, texts) == ["list"] + ["drop"] * (len(texts) - 1)
    broken = [t + "]" for t in texts] + [t[:-1] for t in texts] + [t.replace("}", "]", 1) + "," for t in texts]
    assert set(kinds(spark, broken)) == {"raw"}


def test_random_texts_match_a_strict_parser(spark):
    rng = random.Random(6)
    tokens = ["[", "]", "{", "}", ",", ":", '"a"', "'b'", "1", "-0.5e+7", "01", "true", "null", " ", "\n", '"', "\\",
              '"\\u00e9"', '"\\x"', "\x01", "\x02", '"a\nb"', "nul", "é", '"k":', '"k":[', "[[", "]]"]

    def value(depth):
        kind = rng.randrange(7 if depth else 4)
        if kind < 4:
            return rng.choice(['"s"', "12", "false", '"q\\"[{"', " null "])
        inner = [value(depth - 1) for _ in range(rng.randrange(4))]
        if kind < 6:
            return "[" + ",".join(inner) + "]"
        return "{" + ",".join(f'"k{rng.randrange(2)}" :{x}' for x in inner) + "}"

    texts = ["".join(rng.choice(tokens) for _ in range(rng.randint(1, 9))) for _ in range(4_000)]
    for _ in range(2_000):
        text = value(9)
        texts.append(text)
        at = rng.randrange(len(text))
        texts.append(text[:at] + rng.choice(tokens) + text[at + rng.randrange(2) :])
    sys.setrecursionlimit(10_000)
    wrong = [(t, g) for t, g in zip(texts, kinds(spark, texts)) if g != plain_kind(t)]
    assert not wrong, wrong[:5]
