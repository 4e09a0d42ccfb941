"""Best rows of each group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refrain.schemas import free_name

#: Parts of a group ranked side by side before the final ranking, where Spark does
#: not limit groups before the shuffle itself.
SALTS = 32

_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"


def _falling(df: DataFrame, measure: str) -> Column | None:
    """What sorts rising as the measure sorts falling with NULL first, if it is a number."""
    kind = df.schema[measure].dataType
    column = F.col(f"`{measure}`")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        # NaN is the greatest.
        return F.struct(column.isNotNull(), ~F.isnan(column), -column)
    if isinstance(kind, T.IntegralType):
        # The least number has no opposite in its own type.
        return F.struct(column.isNotNull(), -column.cast("decimal(20,0)"))
    if isinstance(kind, T.DecimalType):
        return F.struct(column.isNotNull(), -column)
    return None


def _best(df: DataFrame, group: str, falling: Column, tie_break: Sequence[str]) -> DataFrame:
    """The first row of each group, by an aggregate that merges before the shuffle."""
    ties = [x for c in tie_break for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    best = df.groupBy(F.col(f"`{group}`").alias("key")).agg(F.min_by(row, F.struct(falling, *ties)).alias("best"))
    return best.select("best.*")


def top_per_group(
    df: DataFrame,
    group: str,
    measure: str,
    tie_break: Sequence[str],
    k: int = 1,
    rank: str | None = None,
) -> DataFrame:
    """The ``k`` rows of each group with the greatest measure.

    NULL measures come first and NULL is a group of its own. Ties are broken by
    ``tie_break`` columns ascending. One row by a number is a minimum, merged within
    each task, so that a task sends one row for each group. Several rows are ranked:
    up to a configured ``k`` Spark limits the groups to ``k`` rows in each task before
    the shuffle; beyond it rows are ranked within SALTS parts of each group first, so a
    group with most of the rows is sorted by many tasks and its last one gets ``k``
    rows from each.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    falling = _falling(df, measure)
    if k == 1 and falling is not None:
        best = _best(df, group, falling, tie_break)
        return best.withColumn(rank, F.lit(1)) if rank else best
    order = [F.desc_nulls_first(measure), *[F.asc_nulls_last(c) for c in tie_break]]
    name = rank or free_name("rank", df.columns)
    part = free_name("part", [*df.columns, name])

    def best(rows: DataFrame, *keys: str) -> DataFrame:
        window = Window.partitionBy(*keys).orderBy(*order)
        return rows.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= k)

    if k > int(df.sparkSession.conf.get(_LIMIT)):
        salt = F.pmod(F.xxhash64(measure, *tie_break), F.lit(SALTS))
        df = best(df.withColumn(part, salt), group, part).drop(part, name)
    ranked = best(df, group)
    return ranked if rank else ranked.drop(name)
