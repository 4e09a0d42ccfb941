"""Typed loads into catalog tables."""

from __future__ import annotations

import json
import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from refrain.operators.quality import observe_rows
from refrain.operators.typed import typed_projection
from refrain.schemas import COLUMN_TYPES, EMPTY_DATASET, require_columns
from refrain.sources.versions import write_version

log = logging.getLogger(__name__)

#: Column and partition of appends that may be repeated.
LOAD_ID = "load_id"


@dataclass(frozen=True)
class LoadReport:
    table: str
    rows: int

    @property
    def loaded(self) -> bool:
        return self.rows > 0


def load_table(
    df: DataFrame,
    table: str,
    mode: str = "overwrite",
    types: dict[str, str] = COLUMN_TYPES,
    on_bad: str = "fail",
    path: str | None = None,
    load_id: str | None = None,
) -> LoadReport:
    """Type an all-text dataset and store it as a catalog table.

    The table is made if it does not exist. ``append`` adds to it, ``overwrite``
    replaces it, so that a repeated load leaves one copy: the rows are written to a
    new folder below ``path`` (by default one named after the table, in the
    warehouse), and only when they are whole is the table pointed there. The table
    is never dropped: one of another schema gets the new one. An empty dataset is
    reported and leaves the catalog alone; a missing required column or a value that
    cannot be stored raises, and then the table is as it was.

    An append with a ``load_id`` is stored once however often it is repeated: the
    table has a column ``load_id`` and a partition for each, which the load replaces.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError("mode must be append or overwrite")
    if load_id is not None and mode != "append":
        raise ValueError("only an append has a load_id")
    if not df.columns or df.isEmpty():
        log.error(EMPTY_DATASET.format(table=table))
        return LoadReport(table, 0)
    require_columns(df.columns, table)
    spark, counts = df.sparkSession, Observation()
    typed = observe_rows(typed_projection(df, types, on_bad), counts)
    home = path or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{table}-versions"
    if load_id is not None:
        _replace_load(typed, table, home, load_id)
    elif mode == "append" and spark.catalog.tableExists(table):
        typed.write.mode("append").format("parquet").saveAsTable(table)
    else:
        folder = write_version(typed, home, lambda rows, place: rows.write.parquet(place))
        _point(spark, table, folder)
    report = LoadReport(table, counts.get["rows"])
    log.info("table %s: %d rows loaded", table, report.rows)
    return report


def _replace_load(typed: DataFrame, table: str, home: str, load_id: str) -> None:
    """Make the rows the partition of ``load_id``, in place of what it had."""
    spark = typed.sparkSession
    # It names a folder, and not every file system and JVM takes other characters.
    if not (load_id.isascii() and load_id.isprintable() and load_id):
        raise ValueError("a load_id must be of printable ASCII characters")
    if LOAD_ID in typed.columns:
        raise ValueError(f"the dataset has a column {LOAD_ID} of its own")
    if not spark.catalog.tableExists(table):
        types = ", ".join(f"`{c}` {kind}" for c, kind in [*typed.dtypes, (LOAD_ID, "string")])
        spark.sql(f"CREATE TABLE {table} ({types}) USING parquet PARTITIONED BY ({LOAD_ID}) LOCATION '{home}'")
    held = spark.table(table)
    if dict(held.dtypes) != {**dict(typed.dtypes), LOAD_ID: "string"} or held.columns[-1] != LOAD_ID:
        raise ValueError(f"table {table} has other columns than this load by {LOAD_ID}")
    rows = typed.withColumn(LOAD_ID, F.lit(load_id)).select(*[f"`{c}`" for c in held.columns])
    # The files of this partition only, and only when the new ones are whole.
    one = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    one.partitionBy(LOAD_ID).parquet(_described(spark, table)["Location"])
    literal = load_id.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({LOAD_ID} = '{literal}')")
    spark.sql(f"REFRESH TABLE {table}")


def _described(spark: SparkSession, table: str) -> dict[str, str]:
    return {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}


def _point(spark: SparkSession, table: str, folder: str) -> None:
    """Make ``table`` the Parquet files in ``folder``; only the catalog changes.

    A table of another schema is pointed there first: until its columns are those of
    the files too, it reads as it was declared.
    """
    new = spark.read.parquet(folder).schema
    if not spark.catalog.tableExists(table):
        spark.catalog.createTable(table, path=folder, source="parquet", schema=new)
        return
    about = _described(spark, table)
    if about.get("Provider", "").lower() != "parquet" or "# Partition Information" in about:
        raise ValueError(f"table {table} is no plain Parquet table; it is left as it is")
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
    if spark.table(table).schema != new:
        _set_schema(spark, table, new)
    spark.sql(f"REFRESH TABLE {table}")


def _set_schema(spark: SparkSession, table: str, schema: StructType) -> None:
    """Replace the columns of a table in one step of the catalog, which SQL lacks."""
    found = spark.catalog.getTable(table)
    catalog = spark._jsparkSession.sessionState().catalog().externalCatalog()
    kind = spark._jvm.org.apache.spark.sql.types.DataType.fromJson(schema.json())
    catalog.alterTableDataSchema(found.namespace[0], found.name, kind)


_HOT = "refrain.hot."


def record_hot_keys(spark: SparkSession, table: str, column: str, keys: list[str]) -> None:
    """Keep, as a property of the table, which values of a column many rows have."""
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{_HOT}{column}' = '{json.dumps(keys).encode().hex()}')")


def table_hot_keys(spark: SparkSession, table: str) -> dict[str, list[str]]:
    """What ``record_hot_keys`` has kept, by column; nothing for a view or no table."""
    if not spark.catalog.tableExists(table) or spark.catalog.getTable(table).tableType in ("VIEW", "TEMPORARY"):
        return {}
    found = spark.sql(f"SHOW TBLPROPERTIES {table}").where(F.col("key").startswith(_HOT)).collect()
    return {r.key.removeprefix(_HOT): json.loads(bytes.fromhex(r.value)) for r in found}
