"""Preparing items as their files arrive.

Preparing is stateless, so the stream needs neither watermark nor state and
each file is written exactly once. Pruning entities needs the ids of all items:
that is a batch step over what the stream has written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from refrain.operators.prepare import ITEM, ItemColumns, prepare_items
from refrain.schemas import MIN_DURATION_MS
from refrain.sources.csv import judged_rows, raw_schema


def stream_raw_csv(
    spark: SparkSession,
    folder: str,
    columns: list[str],
    multi_line: bool = True,
    files_per_batch: int | None = None,
    faults: str | None = None,
) -> DataFrame:
    """Rows of the CSV files in a folder, new files included, every field text.

    A file is read by one task, with line breaks inside quotes; without
    ``multi_line`` files are split, and must not have such breaks. Long rows raise,
    or are marked in ``faults`` as by ``read_raw``. ``files_per_batch`` divides a large
    backlog into several commits.
    """
    schema, options = raw_schema(columns)
    reader = spark.readStream.schema(schema).options(**options, multiLine=multi_line)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return judged_rows(reader.csv(folder), columns, faults)


def write_prepared_stream(
    raw: DataFrame,
    target: str,
    checkpoint: str,
    min_duration: float = MIN_DURATION_MS,
    columns: ItemColumns = ITEM,
) -> StreamingQuery:
    """Prepare all files there are now, write them as Parquet and stop.

    Started again with the same checkpoint it takes up the files that are new.
    """
    return (
        prepare_items(raw, min_duration, columns)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .option("path", target)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
