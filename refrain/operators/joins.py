"""Equi-joins that hold when one key has a large share of the rows.

Without known hot keys this is Spark's own join: it broadcasts a small side, and
adaptive execution splits a skewed partition. Keys that are known to be hot, measured
by ``hot_keys``, are spread over salts beforehand: only their left rows get a salt and
only their right rows are repeated, once for each salt, which also holds where the
right side is an aggregate. Everything is one lazy join with one scan of each side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refrain.schemas import free_name

#: Parts that a hot key is spread over. One with a share s of the left rows puts
#: s / SALTS in a part; there are more parts than Spark has shuffle partitions by
#: default, so that no part is larger than what else is in a partition.
SALTS = 256

#: A key is hot from this share of the rows on; so there are at most 50 hot keys.
HOT_SHARE = 0.02
_MOST_HOT = 50

#: Keys that the sketch of frequent keys holds; its counts err by less than a
#: thousandth of the rows.
_TRACKED = 8_192


def hot_keys(df: DataFrame, key: str | Column, share: float = HOT_SHARE) -> list:
    """The keys with at least ``share`` of all rows, of which there are few.

    One pass with a sketch of fixed size in each task; NULL counts as no key.
    """
    keys = df.select((F.col(key) if isinstance(key, str) else key).alias("k"))
    found = keys.agg(
        F.count("*").alias("rows"), F.expr(f"approx_top_k(k, {_MOST_HOT}, {_TRACKED})").alias("top")
    ).first()
    least = share * found.rows
    return [t["item"] for t in found.top or [] if t["item"] is not None and t["count"] >= least]


def salted_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "inner",
    salts: int = SALTS,
    hot: Sequence = (),
) -> DataFrame:
    """``inner``, ``left`` or ``left_semi`` join on ``key``; both sides may repeat it.

    Rows of the keys in ``hot``, and with them left rows without a key, are spread
    over ``salts``. Right columns other than
    the key must have names of their own. Columns of map type cannot be hashed and do
    not spread their rows.
    """
    if how == "left_semi":
        right = right.select(key).distinct()
    if not hot:
        return left.join(right, key, how)
    zero, salt = F.lit(0), free_name("salt", [*left.columns, *right.columns])
    is_hot = F.col(f"`{key}`").isin(list(hot))
    hashed = [F.col(f"`{c}`") for c, kind in left.dtypes if not kind.startswith("map")]
    spread = F.pmod(F.xxhash64(*hashed), F.lit(salts)).cast("int")
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    left = left.withColumn(salt, F.when(is_hot | F.col(f"`{key}`").isNull(), spread).otherwise(zero))
    right = right.withColumn(salt, F.explode(F.when(is_hot, every).otherwise(F.array(zero))))
    return left.join(right, [key, salt], how).drop(salt)
