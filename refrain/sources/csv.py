"""CSV with a header, every field text.

Paths are anything Spark can read (``file:``, ``s3a:``, ``hdfs:``, a folder or a
glob); a path that does not exist raises ``PATH_NOT_FOUND``. A dataset written in
versions is read in its newest whole one. Line breaks inside quotes are kept and
files are split among tasks all the same, see ``refrain.sources.records``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refrain.schemas import free_name
from refrain.sources.records import stored_records
from refrain.sources.versions import current

# A quote inside a quoted field is written twice.
DIALECT = {"sep": ",", "quote": '"', "escape": '"', "encoding": "UTF-8"}

# What may be wrong with the shape of a row.
SHORT_ROW, LONG_ROW = "short_row", "long_row"

_RECORD = "_record"
_TORN = "a quoted field goes on in the next line; read with multi_line=True: "
_LONG = "a row has more fields than the header: "
_MALFORMED = "malformed row, with more or fewer fields than the header: "


def header_columns(
    spark: SparkSession, path: str | list[str], multi_line: bool = False
) -> list[str]:
    """Column names from the header; empty for an empty file."""
    reader = spark.read.options(**DIALECT, header=True, multiLine=multi_line)
    return reader.csv(path).columns


def text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])


def _scan(spark, path, columns, multi_line, mode, record=None) -> DataFrame:
    more = {"columnNameOfCorruptRecord": record} if record else {}
    return (
        spark.read.schema(text_schema([*columns, *([record] if record else [])]))
        # Files of one folder must agree on their header; a file with other
        # columns fails instead of shifting its values.
        .options(**DIALECT, header=True, enforceSchema=False)
        .options(multiLine=multi_line, mode=mode, **more)
        .csv(path)
    )


def _fields(record: Column) -> Column:
    """Number of fields of a CSV record."""
    bare = F.regexp_replace(record, '"[^"]*+"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1


def _torn_lines(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """No rows, but an error if a line holds an odd number of quotes.

    Read line by line, such a record would fall apart into wrong rows.
    """
    line = F.col("value")
    quotes = F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))
    torn = F.raise_error(F.concat(F.lit(_TORN), F.left(line, F.lit(200)))).cast("boolean")
    nothing = [F.lit(None).cast("string").alias(name) for name in columns]
    lines = spark.read.text(path)
    return lines.filter(F.when(quotes % 2 == 1, torn).otherwise(F.lit(False))).select(*nothing)


def _parsed(records: DataFrame, columns: list[str], record: str) -> DataFrame:
    """The fields of ``record`` and, in a column ``record``, those of another width."""
    names = [*columns, record]
    schema = text_schema(names).toDDL() if names else ""
    # A generator takes each record apart once, whatever is read of it.
    fields = F.from_csv(F.col("record").cast("string"), F.lit(schema), {
        **{k: v for k, v in DIALECT.items() if k != "encoding"}, "multiLine": "true",
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": record,
    })
    others = [F.col(f"`{c}`") for c in records.columns if c != "record"]
    return records.select(*others, F.inline(F.array(fields)))


def read_raw(
    spark: SparkSession,
    path: str | list[str],
    multi_line: bool = True,
    faults: str | None = None,
    then: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Raw dataset, nothing NULL: the missing fields of a short row read as blank.

    With ``faults`` a column of that name says ``short_row``, ``long_row`` or NULL;
    the row has the fields that the header names. Without it a long row raises.
    The text is scanned once, by many tasks, when this is called; ``then`` is done to
    the rows in the same job, and what it makes is kept in a scratch dataset, of which
    the rows are read. It must work row by row and keep all columns. Without
    ``multi_line`` nothing is stored, the scan is lazy, and a record that goes on in
    the next line raises. An empty file has no columns and no rows. Of several paths
    all files must have one header.
    """
    path = current(spark, path) if isinstance(path, str) else path
    columns = header_columns(spark, path, multi_line)
    if not columns:
        return spark.createDataFrame([], T.StructType([]))
    record = free_name(_RECORD, columns)
    if multi_line:
        def made(records: DataFrame) -> DataFrame:
            rows = judged_rows(_parsed(records, columns, record), columns, faults, record)
            return then(rows) if then else rows

        return stored_records(spark, path, columns, made)
    rows = _scan(spark, path, columns, False, "PERMISSIVE", record)
    rows = rows.unionByName(_torn_lines(spark, path, [*columns, record]))
    rows = judged_rows(rows, columns, faults, record)
    return then(rows) if then else rows


def judged_rows(
    rows: DataFrame, columns: list[str], faults: str | None, kept: str = _RECORD
) -> DataFrame:
    """Scanned rows with their fault in ``faults``, or without long rows allowed.

    Column ``kept`` has the text of rows of another width than the header's.
    """
    record = F.col(kept)
    fault = F.when(
        record.isNotNull(),
        F.when(_fields(record) > len(columns), F.lit(LONG_ROW)).otherwise(F.lit(SHORT_ROW)),
    )
    if faults:
        return rows.fillna("", subset=columns).withColumn(faults, fault).drop(kept)
    refused = F.raise_error(F.concat(F.lit(_LONG), F.left(record, F.lit(200)))).cast("boolean")
    whole = rows.filter(F.when(fault == LONG_ROW, refused).otherwise(F.lit(True)))
    return whole.drop(kept).fillna("", subset=columns)


def raw_schema(columns: list[str]) -> tuple[T.StructType, dict]:
    """Schema and options of a scan for ``judged_rows``."""
    options = {**DIALECT, "header": True, "enforceSchema": False, "columnNameOfCorruptRecord": _RECORD}
    return text_schema([*columns, _RECORD]), options


def read_prepared(
    spark: SparkSession, path: str, multi_line: bool = True
) -> DataFrame:
    """Prepared dataset for loading: a row of the wrong width fails the job.

    Scanned once when this is called, as by ``read_raw``, and blank fields are blank.
    """
    path = current(spark, path)
    columns = header_columns(spark, path, multi_line)
    if not columns:
        return spark.createDataFrame([], T.StructType([]))
    if not multi_line:
        return _scan(spark, path, columns, False, "FAILFAST")
    record = free_name(_RECORD, columns)
    refused = F.raise_error(F.concat(F.lit(_MALFORMED), F.left(F.col(record), F.lit(200))))

    def made(records: DataFrame) -> DataFrame:
        rows = _parsed(records, columns, record)
        whole = rows.filter(F.when(F.col(record).isNotNull(), refused.cast("boolean")).otherwise(F.lit(True)))
        return whole.drop(record).fillna("", subset=columns)

    return stored_records(spark, path, columns, made)
