"""The whole prepare job over files as they arrive, batch by batch.

The stream is of the names of new files; each batch reads its files as the batch job
does, so they are split among tasks and line breaks in quotes stay. A batch is
classified once: kept items, rejected ones with their reasons and the counts come
from the same rows. The ids that the items refer to are a state kept in the target:
a batch adds those not seen before and keeps the entities that have them, so that an
entity is there as soon as its first item is, and only once.

What a batch made stands in a folder of its own and is entered in the target's log
under the number of the batch, with all its parts at once. A batch that is run again
after a failure finds that entry, or begins anew: nothing is stored twice or lost.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from refrain import files
from refrain.operators.bloom import bloom_filter
from refrain.operators.prepare import (
    ITEM,
    ROW_FAULT,
    ItemColumns,
    append_item_columns,
    classify_items,
    entity_ids,
    prune_entities,
)
from refrain.operators.quality import count_classified
from refrain.schemas import MIN_DURATION_MS
from refrain.session import scratch_scope
from refrain.sources.csv import read_raw

#: The parts of what a batch leaves.
ITEMS, REJECTS, IDS, ENTITIES = PARTS = ("items", "rejects", "ids", "entities")

_FILES = "path string, modificationTime timestamp, length bigint, content binary"
_FOLDER = "b-"


def _entry(target: str, batch_id: int) -> str:
    return f"{target}/_log/{batch_id:020}.json"


def committed(spark: SparkSession, target: str) -> dict[int, dict]:
    """What the log says of each whole batch: its folder, its parts and its counts."""
    target = target.rstrip("/")
    names = [n for n in files.listed(spark, f"{target}/_log") if n.removesuffix(".json").isdigit()]
    numbers = sorted(int(n.removesuffix(".json")) for n in names)
    return {n: json.loads(files.read_text(spark, _entry(target, n))) for n in numbers}


def read_batches(spark: SparkSession, target: str, part: str, upto: int | None = None) -> DataFrame | None:
    """One part of all whole batches, or of those before batch ``upto``; None if there is none."""
    target = target.rstrip("/")
    paths = [
        f"{target}/{entry['folder']}/{part}"
        for number, entry in committed(spark, target).items()
        if part in entry["parts"] and (upto is None or number < upto)
    ]
    return spark.read.option("mergeSchema", True).parquet(*paths) if paths else None


def _prepared(
    spark: SparkSession, paths: list[str], target: str, folder: str, batch_id: int,
    entities: Callable[[], DataFrame], min_duration: float, columns: ItemColumns,
) -> dict:
    """Write the parts of one batch; returns its counts."""
    rows = read_raw(spark, paths, faults=ROW_FAULT, then=lambda r: classify_items(r, min_duration, columns))
    if not rows.columns:
        return {"parts": [], "counts": {}}
    kept = rows.where(F.col("reject_reason").isNull())
    found = [c for c in (ROW_FAULT, "reject_reason", "list_kind") if c in rows.columns]
    append_item_columns(kept.drop(*found), columns).write.parquet(f"{folder}/{ITEMS}")
    rejects = rows.where(F.col("reject_reason").isNotNull())
    rejects.drop(ROW_FAULT, "list_kind").write.parquet(f"{folder}/{REJECTS}")
    ids = entity_ids(kept, columns.ids)
    seen = read_batches(spark, target, IDS, batch_id)
    if seen is not None:
        ids = ids.join(seen, "id", "left_anti")
    ids.write.parquet(f"{folder}/{IDS}")
    new = spark.read.schema("id string").parquet(f"{folder}/{IDS}")
    prune_entities(entities(), new, sieve=bloom_filter(new)).write.parquet(f"{folder}/{ENTITIES}")
    return {"parts": list(PARTS), "counts": count_classified(rows)}


def prepare_stream(
    spark: SparkSession,
    source: str,
    entities: Callable[[], DataFrame],
    target: str,
    checkpoint: str,
    min_duration: float = MIN_DURATION_MS,
    columns: ItemColumns = ITEM,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Prepare all files of a folder there are now, and stop.

    Started again with the same checkpoint it takes up the files that are new.
    ``entities`` gives the entities to prune, anew for each batch. ``read_batches``
    reads what is whole; ``files_per_batch`` divides a large backlog into several
    batches. A record that is torn or too long is handled as by ``read_raw``: an open
    quote fails the batch, which leaves nothing behind.
    """
    target = target.rstrip("/")

    def run(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        if files.exists(session, _entry(target, batch_id)):
            return
        # The names of the batch's files, which the source itself lists in the driver.
        paths = [r.path for r in batch.collect()]
        name = f"{_FOLDER}{batch_id}-{uuid.uuid4().hex}"
        folder = f"{target}/{name}"
        try:
            with scratch_scope(session):
                made = {"parts": [], "counts": {}}
                if paths:
                    made = _prepared(
                        session, paths, target, folder, batch_id, entities, min_duration, columns
                    )
            whole = files.put_if_absent(session, _entry(target, batch_id), json.dumps({"folder": name, **made}))
        except Exception:
            # The entry may have been made although that failed in the end.
            if not files.exists(session, _entry(target, batch_id)):
                files.remove(session, folder)
            raise
        if not whole:
            files.remove(session, folder)

    reader = spark.readStream.format("binaryFile").schema(_FILES)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # Only the names are read: the column with the contents is pruned.
    names = reader.load(source).select("path")
    return (
        names.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def clear_failed_batches(spark: SparkSession, target: str, older_than_hours: float = 24) -> list[str]:
    """Remove folders of batches that never became whole; returns them."""
    target = target.rstrip("/")
    whole = {entry["folder"] for entry in committed(spark, target).values()}
    since = time.time() * 1000 - older_than_hours * 3_600_000
    gone = [
        f"{target}/{name}"
        for name, changed in files.listed(spark, target).items()
        if name.startswith(_FOLDER) and name not in whole and changed < since
    ]
    for folder in gone:
        files.remove(spark, folder)
    return gone
