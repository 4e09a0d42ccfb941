"""What two operators share: finding windows that repeat anywhere in a corpus.

All windows of a document (20 words, or 200 bytes) are shipped as *runs*:
consecutive windows with the same anchor, the smallest hash of the grams in a
window. Equal windows have equal anchors at equal places, so

* a window can only repeat if its anchor occurs twice: other runs are dropped;
* runs with equal anchor and equal content repeat as a whole and are settled
  without looking at single windows;
* only different contents under one anchor are left. One run of each such content
  is *open*: its windows must be looked at one by one, in the document's text.

Counts go through partial aggregation and joins on hashes whose two sides are both
shuffled, so that Spark can split hot anchors; nothing is collected in one place.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refrain.llm.common import map_texts, release, sliced, stored
from refrain.llm.spans import Runs, chunks

KEY = "struct<doc_id:bigint,text_hash:bigint>"
#: Makes the runs of some texts; items of text i start at the returned places.
MakeRuns = Callable[[list[bytes]], tuple[Runs, np.ndarray]]


def keyed_texts(docs: DataFrame, carried: list[str] | None = None) -> DataFrame:
    """``doc_id`` with a hash of the text as the key, and ``text``, NULL as empty.

    Rows that repeat an id with another text are documents of their own. The
    ``carried`` columns come along in a struct ``rest``.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"))
    rest = [F.struct(*(docs[c] for c in carried)).alias("rest")] if carried else []
    return docs.select(key.alias("doc_id"), text.alias("text"), *rest)


def repeated_anchors(docs: DataFrame, make: MakeRuns) -> DataFrame:
    """The anchors that occur at least twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            for _, chunk in chunks(batch["text"].to_pylist()):
                anchors, times = np.unique(make(chunk)[0].anchor, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchors.view(np.int64)), pa.array(times)],
                    names=["anchor", "times"],
                )

    found = docs.select("text").mapInArrow(run, "anchor bigint, times bigint")
    return found.groupBy("anchor").agg(F.sum("times").alias("times")).where("times > 1").select("anchor")


def all_runs(docs: DataFrame, make: MakeRuns) -> DataFrame:
    """Every run of every document; ``start`` counts from the document's start."""

    def run(texts: list[str]) -> dict:
        parts = {name: [] for name in ("row", "anchor", "content", "start", "count")}
        for first, chunk in chunks(texts):
            runs, begin = make(chunk)
            parts["row"].append(runs.text + first)
            parts["anchor"].append(runs.anchor.view(np.int64))
            parts["content"].append(runs.content.view(np.int64))
            parts["start"].append((runs.start - begin[runs.text]).astype(np.int32))
            parts["count"].append(runs.count.astype(np.int32))
        return {name: np.concatenate(p or [np.empty(0, np.int32)]) for name, p in parts.items()}

    return map_texts(docs, run, "anchor bigint, content bigint, start int, count int", KEY)


def settle_runs(
    docs: DataFrame, make: MakeRuns, keep_first: bool
) -> tuple[DataFrame, list[DataFrame]]:
    """The ``closed`` runs, which repeat as a whole, and the ``open`` runs of each
    document that has any; and the stored tables that this is read from.

    ``keep_first`` says whether the first of equal runs (smallest document, then
    start) is spared. Rows that repeat id and text have the same runs, which are
    listed once for all of them.
    """
    anchors = stored(repeated_anchors(docs, make), "anchors")
    runs = stored(all_runs(docs, make).join(anchors, "anchor", "left_semi"), "runs")
    release(anchors)
    place = F.struct("doc_id", "start")
    contents = stored(
        runs.groupBy("anchor", "content").agg(
            F.min(place).alias("first"), F.max("count").alias("count"), F.count("*").alias("copies")
        ),
        "run-contents",
    )
    shared = stored(
        contents.groupBy("anchor").agg(F.count("*").alias("contents")).where("contents > 1"),
        "shared-anchors",
    )
    open_runs = contents.join(shared, "anchor").select(
        F.col("first.doc_id").alias("doc_id"),
        F.lit(None).alias("closed"),
        F.struct(F.col("first.start").alias("start"), "count", "copies", "contents", "anchor").alias("open"),
    )
    copied = contents.where("copies > 1").select("anchor", "content", "first")
    closed = runs.join(copied, ["anchor", "content"])
    if keep_first:
        closed = closed.where(place != F.col("first"))
    closed = closed.select("doc_id", F.struct("start", "count").alias("closed"), F.lit(None).alias("open"))
    lists = closed.unionByName(open_runs).groupBy("doc_id").agg(
        F.collect_set("closed").alias("closed"), F.collect_list("open").alias("open")
    )
    return lists, [runs, contents, shared]


def with_runs(docs: DataFrame, lists: DataFrame) -> DataFrame:
    """``docs`` with ``closed`` and ``open``; documents without runs have NULL."""
    lists = lists.withColumnRenamed("doc_id", "key")
    return docs.join(lists, F.col("doc_id") == F.col("key"), "left").drop("key")


def starts_of(runs: list[dict] | None) -> np.ndarray:
    """The starts of all windows of some runs."""
    if not runs:
        return np.empty(0, np.int64)
    return np.concatenate([np.arange(r["start"], r["start"] + r["count"]) for r in runs])
