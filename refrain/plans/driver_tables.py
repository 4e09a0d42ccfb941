"""Catalogue-shaped relations derived from the driver tables.

Each is a row-by-row projection of whole tables: an item per line of
``lineitem``, an entity per ``part`` and ``supplier``. The expressions are SQL
that Spark and the checking engine both read, so that the two sides of a check
start from the same rows and differ in everything that is under test.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_DOLLARS = "cast(floor(l_extendedprice) as bigint)"
_CENTS = "cast(floor(l_discount * 100 + 0.5) as bigint)"
_Y, _M, _D = "year(l_shipdate)", "month(l_shipdate)", "day(l_shipdate)"
_MM, _DD = f"lpad(concat({_M}), 2, '0')", f"lpad(concat({_D}), 2, '0')"
_ZERO_WIDTH, _NO_BREAK = chr(0x200B), chr(0x00A0)


def _quoted(expression: str) -> str:
    """``^`` stands for a single quote in list texts."""
    return f"replace({expression}, '^', chr(39))"


# Raw items: every field text, as a CSV file would give them.
RAW_ITEMS = {
    "id": "concat(l_orderkey, '-', l_linenumber)",
    "name": f"""CASE
        WHEN l_linenumber = 1 AND l_returnflag = 'R' THEN ''
        WHEN l_linenumber = 2 AND l_returnflag = 'R' THEN ' {_NO_BREAK} '
        ELSE concat(' ', l_returnflag, l_linestatus, ', "line" ', l_linenumber) END""",
    "popularity": """CASE WHEN l_linenumber = 7 THEN 'none'
        ELSE concat(cast(floor(l_quantity) as bigint), '.9 pts') END""",
    "duration_ms": f"""CASE l_linenumber
        WHEN 1 THEN concat({_DOLLARS})
        WHEN 2 THEN concat({_DOLLARS}, '.5')
        WHEN 3 THEN concat('{_NO_BREAK} ', {_DOLLARS}, ' ')
        WHEN 4 THEN concat(cast(floor(l_extendedprice / 10000) as bigint), 'e4')
        WHEN 5 THEN CASE WHEN l_linestatus = 'O' THEN concat({_DOLLARS}, 'ms')
                         ELSE concat({_DOLLARS}) END
        WHEN 6 THEN CASE WHEN l_returnflag = 'A' THEN '' ELSE concat({_DOLLARS}) END
        ELSE concat('0x', {_DOLLARS}) END""",
    "explicit": """CASE WHEN l_linestatus = 'O' THEN 'True'
        WHEN l_returnflag = 'A' THEN '0' WHEN l_returnflag = 'N' THEN '1'
        ELSE 'no' END""",
    "id_artists": _quoted(
        """CASE
        WHEN l_returnflag = 'A' THEN concat('[^p', l_partkey, '^, ^s', l_suppkey, '^]')
        WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN concat('["p', l_partkey, '"]')
        WHEN l_returnflag = 'N'
            THEN concat('[ ^ p', l_partkey, ' ^ , " ", ^s', l_suppkey, '^]')
        WHEN l_linestatus = 'O'
            THEN concat('[', l_partkey, ', ', l_suppkey, ']')
        WHEN l_linenumber < 3 THEN '[]'
        WHEN l_linenumber = 3 THEN ''
        ELSE concat('["p', l_partkey, '^s"]') END"""
    ),
    "release_date": f"""CASE l_linenumber
        WHEN 1 THEN concat({_Y}, '-', {_MM}, '-', {_DD})
        WHEN 2 THEN concat({_DD}, '/', {_MM}, '/', {_Y})
        WHEN 3 THEN concat({_D}, '/', {_M}, '/', {_Y})
        WHEN 4 THEN concat(' ', {_Y}, ' ')
        WHEN 5 THEN concat({_Y}, '-', {_MM})
        WHEN 6 THEN concat({_Y}, '{_ZERO_WIDTH}', '-', {_MM}, '-', {_DD})
        ELSE '' END""",
    "danceability": f"""CASE l_linenumber
        WHEN 1 THEN concat('0.', {_CENTS})
        WHEN 2 THEN concat('.', {_CENTS}, '1')
        WHEN 3 THEN concat('-', {_CENTS})
        WHEN 4 THEN concat({_CENTS})
        WHEN 5 THEN 'abc'
        WHEN 6 THEN ''
        ELSE concat(' ', {_CENTS}, 'e-1{_NO_BREAK}') END""",
    "energy": f"""CASE WHEN l_linenumber = 3 THEN '' WHEN l_linenumber = 4 THEN 'x'
        ELSE concat({_DOLLARS}, '.25 units') END""",
}

# Typed items. ``members`` is the id list with | between elements; besides plain
# ids it has NULL, no elements, repeats, brackets, commas and unknown ids.
TYPED_ITEMS = {
    "id": RAW_ITEMS["id"],
    "name": "concat(l_returnflag, l_linestatus)",
    "popularity": "CASE WHEN l_linenumber < 6 THEN cast(floor(l_quantity) as int) END",
    "energy": "CASE WHEN l_linenumber > 1 THEN l_extendedprice END",
    "danceability_level": """CASE WHEN l_tax < 0.03 THEN 'Low'
        WHEN l_tax < 0.06 THEN 'Medium' END""",
    "release_year": f"CASE WHEN l_linenumber < 7 THEN cast({_Y} as int) END",
    "members": """CASE
        WHEN l_returnflag = 'A' THEN concat('p', l_partkey, '|s', l_suppkey)
        WHEN l_returnflag = 'N' AND l_linestatus = 'O'
            THEN concat('p', l_partkey, '|p', l_partkey)
        WHEN l_returnflag = 'N' THEN concat('p', l_partkey, ', s', l_suppkey)
        WHEN l_linestatus = 'O' THEN concat('["p', l_partkey, '"| x', l_suppkey, ' ]')
        WHEN l_linenumber < 4 THEN '' END""",
}

# The same with a third of the rows belonging to one entity alone.
HOT_ITEMS = TYPED_ITEMS | {
    "members": f"CASE WHEN l_suppkey % 3 = 0 THEN 'p1' ELSE {TYPED_ITEMS['members']} END"
}

# Typed entities: (table, filter, columns). Some parts come twice.
TYPED_ENTITIES = (
    (
        "part",
        "true",
        {
            "id": "concat('p', p_partkey)",
            "name": "p_name",
            "followers": """CASE WHEN p_size < 5 THEN NULL WHEN p_size < 10 THEN 0
                ELSE p_size END""",
        },
    ),
    (
        "part",
        "p_size > 45",
        {
            "id": "concat('p', p_partkey)",
            "name": "concat(p_name, ' again')",
            "followers": "1",
        },
    ),
    (
        "supplier",
        "true",
        {
            "id": "concat('s', s_suppkey)",
            "name": "s_name",
            "followers": "cast(floor(s_acctbal) as int)",
        },
    ),
)

# Raw entities: every field text.
RAW_ENTITIES = (
    (
        "part",
        "true",
        {
            "id": "concat('p', p_partkey)",
            "followers": "CASE WHEN p_size < 5 THEN '' ELSE concat(p_size, '.0') END",
            "genres": _quoted("concat('[^', p_type, '^, \"', p_brand, ', it^s\"]')"),
            "name": "p_name",
            "popularity": "concat(p_size)",
        },
    ),
    (
        "supplier",
        "true",
        {
            "id": "concat('s', s_suppkey)",
            "followers": "concat(cast(floor(s_acctbal) as bigint))",
            "genres": "'[]'",
            "name": "s_name",
            "popularity": "''",
        },
    ),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _select_sql(columns: dict[str, str], source: str, where: str = "true") -> str:
    fields = ", ".join(f"{expression} AS {name}" for name, expression in columns.items())
    return f"SELECT {fields} FROM {source} WHERE {where}"


def _select(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{e} AS {name}" for name, e in columns.items()])


def _union(spark, sf_dir, parts) -> DataFrame:
    first, *others = [
        _select(table(spark, sf_dir, source).filter(where), columns)
        for source, where, columns in parts
    ]
    for other in others:
        first = first.unionByName(other)
    return first


def _union_sql(parts) -> str:
    return " UNION ALL ".join(_select_sql(c, source, where) for source, where, c in parts)


def raw_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(table(spark, sf_dir, "lineitem"), RAW_ITEMS)


def typed_items(
    spark: SparkSession, sf_dir: str, columns: dict[str, str] = TYPED_ITEMS
) -> DataFrame:
    df = _select(table(spark, sf_dir, "lineitem"), columns)
    no_elements = F.array().cast("array<string>")
    elements = F.when(F.col("members") == "", no_elements).otherwise(
        F.split("members", r"\|")
    )
    return df.withColumn("id_artists", elements).drop("members")


def raw_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _union(spark, sf_dir, RAW_ENTITIES)


def typed_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _union(spark, sf_dir, TYPED_ENTITIES)


RAW_ITEMS_SQL = _select_sql(RAW_ITEMS, "lineitem")
TYPED_ITEMS_SQL = _select_sql(TYPED_ITEMS, "lineitem")
RAW_ENTITIES_SQL = _union_sql(RAW_ENTITIES)
HOT_ITEMS_SQL = _select_sql(HOT_ITEMS, "lineitem")
TYPED_ENTITIES_SQL = _union_sql(TYPED_ENTITIES)
