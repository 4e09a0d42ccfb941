"""One thin query for each operator, over the whole driver tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refrain.llm import (
    conversations,
    decontamination,
    language_id,
    line_frequency,
    ngram_join,
    oracle,
    packing,
    simhash,
    spelling,
    suffix_dedup,
    toxicity,
    url_filter,
    window_dedup,
    wrappers,
)
from refrain.llm.common import stored

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where there is one, the SQL that checks it."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE_SQL[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(~toxicity.held_out_split())
    scored = toxicity.score_documents(docs, toxicity.fit(docs, labels))
    return scored.select("doc_id", toxicity.held_out_split().alias("held_out"), "score", "predicted")


@query(
    oracle.line_frequency(
        "source", line_frequency.MIN_DOCS, line_frequency.MAX_SHARE, line_frequency.MAX_DOCS,
        line_frequency.MAX_REMOVED, line_frequency.MIN_WORDS, line_frequency.MAX_REPEATED,
    )
)
def op2_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = line_frequency.judge_lines(table(spark, sf_dir, "documents"), "source")
    return judged.drop("removed_lines")


@query(oracle.window_dedup(window_dedup.WIDTH))
def op3_window_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_dedup.remove_repeats(table(spark, sf_dir, "documents"))


@query(oracle.contained_items(decontamination.SHINGLE_WORDS, 80))
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contained_items(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


@query()
def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract_text(table(spark, sf_dir, "pages"))


#: The rules that the contract of the query fixes: host, path, verdict.
URL_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


@query(oracle.url_filter(URL_RULES))
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.sql(
        f"SELECT * FROM VALUES {', '.join(map(str, URL_RULES))} AS r(host, path, verdict)"
    )
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), rules, ["page_id"])


@query()
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    pieces = stored(packing.token_pieces(table(spark, sf_dir, "documents"), path), "pieces")
    return packing.pack_pieces(pieces, pieces.count())


@query()
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = language_id.held_out_split()
    found = language_id.identify(docs, language_id.fit(docs.where(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


@query()
def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


@query(oracle.ngram_join(ngram_join.SHINGLE_WORDS, ngram_join.SIMILARITY))
def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_documents(table(spark, sf_dir, "documents")).drop("class")


@query()
def op12_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_copies(table(spark, sf_dir, "documents"))


#: The contract damages a run where this divides the crc32 of ``<doc_id>:<run>``.
DAMAGED_EVERY = 199


@query()
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"), DAMAGED_EVERY)


@query()
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(table(spark, sf_dir, "conversations"), damage=True)
