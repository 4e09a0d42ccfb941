"""The corpus pipeline: stages over ``documents``, each stored before the next."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from refrain.llm import decontamination, ngram_join, packing, suffix_dedup, toxicity
from refrain.llm.common import drop_tables, release, scratch_scope, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Scratch tables of the stage called last. Its result is written and read again
#: before the next one is called, so they can go then.
_left: list[str] = []


def _clearing(stage: Stage) -> Stage:
    """``stage``, but first the scratch tables of the stage before are dropped."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        drop_tables(spark, _left)
        with scratch_scope() as tables:
            made = stage(spark, docs, sf_dir)
        _left.extend(tables)
        return made

    return run_stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on this input's labels, does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~toxicity.held_out_split())
    return toxicity.keep_unflagged(docs, toxicity.fit(docs, labels))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 80 % of their five-word shingles."""
    return ngram_join.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without byte strings of 200 that repeat anywhere in the kept documents."""
    return suffix_dedup.cut_repeats(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not contain 80 % of the shingles of a benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.drop_contaminated(docs, items)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents as pieces placed in sequences."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    pieces = stored(packing.token_pieces(docs, path), "pieces")
    return packing.pack_pieces(pieces, pieces.count())


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", _clearing(drop_toxic)),
    ("ngram_join", _clearing(drop_near_copies)),
    ("suffix_dedup", _clearing(cut_repeats)),
    ("decontamination", _clearing(drop_contaminated)),
    ("packing", _clearing(pack)),
]

#: Compression, suffix arrays and tokens cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before:
            release(before)
        before = docs
    drop_tables(spark, _left)
    return docs
