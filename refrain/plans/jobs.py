"""The batch jobs: prepare, publish, load."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from refrain.functions.lists import RAW
from refrain.operators.bloom import bloom_filter
from refrain.operators.prepare import (
    ITEM,
    ROW_FAULT,
    append_item_columns,
    classify_items,
    entity_ids,
    prune_entities,
)
from refrain.operators.quality import count_classified, observe_rows
from refrain.plans.views import ENTITIES_TABLE, ITEMS_TABLE, hot_members
from refrain.schemas import MIN_DURATION_MS
from refrain.session import scratch_path, scratch_scope
from refrain.sinks.csv import write_csv
from refrain.sinks.publish import WRITERS, publish_all
from refrain.sinks.tables import LoadReport, load_table, record_hot_keys
from refrain.sources.csv import read_prepared, read_raw, text_schema
from refrain.sources.versions import current

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class PrepareReport:
    """Counts of a prepare run."""

    rows: int
    kept: int
    long_row: int
    no_name: int
    bad_number: int
    too_small: int
    bad_list: int
    raw_lists: int
    short_rows: int
    entities: int


def _read_hop(spark: SparkSession, path: str, fmt: str, multi_line: bool) -> DataFrame:
    """A dataset that one of these jobs has written: every field text."""
    if fmt == "parquet":
        return spark.read.parquet(current(spark, path))
    return read_prepared(spark, path, multi_line)


def transform_csv(
    spark: SparkSession,
    source: str,
    target: str,
    fn: Callable[[DataFrame], DataFrame],
    multi_line: bool = True,
) -> None:
    """Read a CSV dataset, apply any DataFrame transform, write a CSV dataset."""
    with scratch_scope(spark):
        write_csv(read_raw(spark, source, multi_line).transform(fn), target)


def _or_empty(df: DataFrame, columns: list[str]) -> DataFrame:
    """An empty file has no header; it counts as a dataset without rows."""
    if df.columns:
        return df
    return df.sparkSession.createDataFrame([], text_schema(columns))


def prepare_catalogue(
    spark: SparkSession,
    items_source: str,
    entities_source: str,
    items_target: str,
    entities_target: str,
    min_duration: float = MIN_DURATION_MS,
    multi_line: bool = True,
    fmt: str = "parquet",
    rejects_target: str | None = None,
    raw_lists_target: str | None = None,
) -> PrepareReport:
    """Prepare the items, then keep the entities that kept items refer to.

    The raw items are scanned and classified once: all rows with what was found go
    to a scratch dataset in Parquet, and the kept items, the ids, the counts, and on
    request the rejected items with their reasons and the kept items whose list is
    raw text are taken from there. Rows with more fields than the header are rejected,
    columns that the raw items lack read as blank, empty files count as no rows. If a
    step fails the next is not begun, the error is raised, and the targets keep what
    they had; scratch data goes in any case. The targets are Parquet; ``fmt="csv"``
    makes them CSV.
    """
    with scratch_scope(spark):
        return _prepare(
            spark, items_source, entities_source, items_target, entities_target, min_duration,
            multi_line, WRITERS[fmt], rejects_target, raw_lists_target,
        )


def _prepare(
    spark, items_source, entities_source, items_target, entities_target, min_duration,
    multi_line, write, rejects_target, raw_lists_target,
) -> PrepareReport:
    def classified(raw: DataFrame) -> DataFrame:
        return classify_items(raw, min_duration)

    rows = read_raw(spark, items_source, multi_line, ROW_FAULT, classified)
    if not rows.columns:
        rows = classified(_or_empty(rows, ["id", ITEM.name, ITEM.duration]))
    if not multi_line:
        # A lazy scan; it is run once here.
        scratch = scratch_path(spark, "classified")
        rows.write.parquet(scratch)
        rows = spark.read.schema(rows.schema).parquet(scratch)
    found = [c for c in (ROW_FAULT, "reject_reason", "list_kind") if c in rows.columns]
    kept = rows.filter(F.col("reject_reason").isNull())
    write(append_item_columns(kept.drop(*found)), items_target)
    log.info("prepared items written to %s", items_target)

    if rejects_target:
        rejects = rows.filter(F.col("reject_reason").isNotNull())
        write(rejects.drop(ROW_FAULT, "list_kind"), rejects_target)
    if raw_lists_target:
        write(kept.filter(F.col("list_kind") == RAW).drop(*found), raw_lists_target)

    entity_counts = Observation()
    entities = _or_empty(read_raw(spark, entities_source, multi_line), ["id"])
    # The ids are worked out and stored once, for the filter and for the join.
    scratch = scratch_path(spark, "ids")
    entity_ids(kept).write.parquet(scratch)
    ids = spark.read.schema("id string").parquet(scratch)
    entities = prune_entities(entities, ids, sieve=bloom_filter(ids))
    write(observe_rows(entities, entity_counts), entities_target)
    log.info("kept entities written to %s", entities_target)
    return PrepareReport(**count_classified(rows), entities=entity_counts.get["rows"])


def publish_catalogue(
    spark: SparkSession,
    items_path: str,
    entities_path: str,
    items_uri: str,
    entities_uri: str,
    multi_line: bool = True,
    fmt: str = "csv",
    prepared_fmt: str = "parquet",
) -> None:
    """Publish both prepared datasets at the same time, by default as CSV."""
    with scratch_scope(spark):
        publish_all(
            {
                items_uri: _read_hop(spark, items_path, prepared_fmt, multi_line),
                entities_uri: _read_hop(spark, entities_path, prepared_fmt, multi_line),
            },
            fmt,
        )


def load_catalogue(
    spark: SparkSession,
    items_uri: str,
    entities_uri: str,
    items_table: str = ITEMS_TABLE,
    entities_table: str = ENTITIES_TABLE,
    mode: str = "overwrite",
    on_bad: str = "fail",
    multi_line: bool = True,
    fmt: str = "csv",
) -> list[LoadReport]:
    """Load items, then entities; the first failure ends the run.

    Which ids many of the items have is measured on the loaded table and kept with
    it, for the views.
    """
    with scratch_scope(spark):
        reports = [
            load_table(_read_hop(spark, uri, fmt, multi_line), table, mode, on_bad=on_bad)
            for uri, table in ((items_uri, items_table), (entities_uri, entities_table))
        ]
    if reports[0].loaded and ITEM.ids in spark.table(items_table).columns:
        record_hot_keys(spark, items_table, ITEM.ids, hot_members(spark.table(items_table)))
    return reports
