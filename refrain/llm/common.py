"""Small helpers that several operators share."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from refrain.session import shared_dir


_scope: ContextVar[list[str] | None] = ContextVar("scratch tables", default=None)


def _scratch_database(spark: SparkSession) -> str:
    """A database of this application below the shared folder."""
    name = "refrain_scratch_" + re.sub(r"\W", "_", spark.sparkContext.applicationId).lower()
    if not spark.catalog.databaseExists(name):
        spark.sql(f"CREATE DATABASE {name} LOCATION '{shared_dir(spark)}/{name}'")
    return name


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a table in the shared folder and read again.

    Cuts the lineage: a lost executor repeats only what came after, and what
    follows sees real sizes. ``release`` drops the table and its files.
    """
    spark = df.sparkSession
    table = f"{_scratch_database(spark)}.{name.replace('-', '_')}_{uuid.uuid4().hex}"
    df.write.format("parquet").saveAsTable(table)
    tables = _scope.get()
    if tables is not None:
        tables.append(table)
    found = spark.table(table)
    found.scratch_table = table
    return found


def release(*frames: DataFrame) -> None:
    """Drop stored tables from which nothing is read any more."""
    for frame in frames:
        frame.sparkSession.sql(f"DROP TABLE IF EXISTS {frame.scratch_table}")


@contextmanager
def scratch_scope() -> Iterator[list[str]]:
    """Collects the names of tables stored meanwhile, for ``drop_tables``."""
    tables: list[str] = []
    before = _scope.set(tables)
    try:
        yield tables
    finally:
        _scope.reset(before)


def drop_tables(spark: SparkSession, tables: list[str]) -> None:
    while tables:
        spark.sql(f"DROP TABLE IF EXISTS {tables.pop()}")


def unused_name(wanted: str, frame: DataFrame) -> str:
    """``wanted``, made longer until no column of ``frame`` has that name."""
    taken = {c.lower() for c in frame.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def remainder_is(id_column: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves ``remainder``; false for NULL."""
    text = id_column.cast("string").cast("binary")
    return F.coalesce(F.crc32(text) % modulus == remainder, F.lit(False))


def spread_sample(key: Column, expected: int, total: int) -> Column:
    """Keeps about ``expected`` of ``total`` rows, the same ones on every run."""
    share = min(1.0, expected / max(1, total))
    return F.pmod(F.xxhash64(key), F.lit(1 << 30)) < int(share * (1 << 30))


#: Rows handled at once in a task, so that texts are not held many times over.
SLICE_ROWS = 512


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches."""
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(start, SLICE_ROWS)


def map_batches(
    frame: DataFrame, run: Callable[[pa.RecordBatch], dict], schema: str, id_type: str | None = None
) -> DataFrame:
    """``doc_id`` of every row of ``frame`` and the columns that ``run`` makes.

    ``run`` gets a batch and returns a list or array for each column of ``schema``.
    If it returns fewer or more rows than it got, it says in ``row`` which of them
    each is from. Ids pass through as they are, NULL included.
    """
    id_type = id_type or frame.schema["doc_id"].dataType.simpleString()
    full = f"doc_id {id_type}, {schema}"
    target = to_arrow_schema(StructType.fromDDL(full))

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            made = run(batch)
            ids = batch["doc_id"]
            if "row" in made:
                ids = ids.take(pa.array(made["row"], pa.int64()))
            columns = [ids]
            for field in list(target)[1:]:
                made_one = made[field.name]
                if not isinstance(made_one, pa.Array):
                    made_one = pa.array(made_one, field.type)
                columns.append(made_one)
            yield pa.RecordBatch.from_arrays(columns, schema=target)

    return frame.mapInArrow(over, full)


def map_texts(
    docs: DataFrame, run: Callable[[list], dict], schema: str, id_type: str = "bigint"
) -> DataFrame:
    """``map_batches`` over the texts of ``docs`` alone."""
    pair = docs.select(F.col("doc_id").cast(id_type).alias("doc_id"), "text")
    return map_batches(pair, lambda batch: run(batch["text"].to_pylist()), schema, id_type)
