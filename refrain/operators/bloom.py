"""A Bloom filter of ids, so that only probable rows are shuffled to a join.

The filter is a table of words of 64 bits: a hash of an id picks its word, and a
second one four bits of it. It is built by an aggregate and asked by a broadcast join
with at most one word for each row, all in Spark's own expressions. An id that was
put in always passes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refrain.schemas import free_name

#: Words of the filter, each a row of two numbers. It does not grow with the ids, so
#: it may be broadcast: 16 MB. With 4 million ids about one in a hundred others
#: passes, with 16 million one in six.
WORDS = 1 << 20

#: Bits that an id sets in its word, and of the hash that picks each.
_SET, _PICK = 4, 6


def _word(c: Column, words: int) -> Column:
    return F.pmod(F.xxhash64(c, F.lit(1)), F.lit(words))


def _mask(c: Column) -> Column:
    picked = F.xxhash64(c, F.lit(2))
    bits = [F.shiftrightunsigned(picked, _PICK * i).bitwiseAND(F.lit(63)).cast("int") for i in range(_SET)]
    return reduce(Column.bitwiseOR, [F.call_function("shiftleft", F.lit(1).cast("long"), b) for b in bits])


def bloom_filter(ids: DataFrame, words: int = WORDS) -> DataFrame:
    """``word`` and ``bits`` of the filter of the only column of ``ids``, NULL left out."""
    key = F.col(f"`{ids.columns[0]}`")
    rows = ids.where(key.isNotNull()).select(_word(key, words).alias("word"), _mask(key).alias("mask"))
    return rows.groupBy("word").agg(F.bit_or("mask").alias("bits"))


def probable(df: DataFrame, key: str, sieve: DataFrame, words: int = WORDS) -> DataFrame:
    """Rows whose ``key`` may be among the ids that ``sieve`` was made of."""
    word, bits = (free_name(n, df.columns) for n in ("word", "bits"))
    asked = df.withColumn(word, _word(F.col(f"`{key}`"), words))
    found = asked.join(F.broadcast(sieve.toDF(word, bits)), word)
    mask = _mask(F.col(f"`{key}`"))
    return found.where(F.col(bits).bitwiseAND(mask) == mask).select(*[F.col(f"`{c}`") for c in df.columns])
