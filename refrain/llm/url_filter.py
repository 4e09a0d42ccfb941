"""URL rules by expanded expressions and short hash prefixes.

Every distinct (host, path) is expanded into host-suffix + path-prefix
expressions, one for each number of host labels and each path length that any
rule has, so nothing else can match. Expressions meet the rules in an equi-join
on the first four bytes of their SHA-256; the full digest confirms, and the
longest rule wins. All of it is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DEFAULT_VERDICT = "allow"
PREFIX_HEX_DIGITS = 8


def _ascii_lower(column: Column) -> Column:
    return F.translate(column, UPPER, UPPER.lower())


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://`` or for NULL."""
    text = F.coalesce(url, F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substr(text, at + 3)).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), "^[^?#]*", 0)
    return _ascii_lower(host), path


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat_ws("\n", host, path), 256)


def judge_urls(pages: DataFrame, rules: DataFrame, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of every page with ``host``, ``path``, ``rule``, ``verdict``.

    ``pages`` has ``url``; ``rules`` has ``host``, ``path`` and ``verdict``. A rule
    fits its host and all subdomains where the URL's path starts with the rule's.
    The rule with most characters wins, then the one with the longer host; of a
    rule stated twice, ``block`` holds. Rules with a NULL or an empty host fit
    nothing. No rule: ``rule`` is NULL and the verdict DEFAULT_VERDICT. Every row
    stays, repeated ones too; a NULL or malformed URL has empty parts and fits no
    rule; columns not in ``keep`` are left out.
    """
    rules = (
        rules.select(_ascii_lower("host").alias("r_host"), F.col("path").alias("r_path"), "verdict")
        .where("r_host <> '' AND r_path IS NOT NULL")
        .groupBy("r_host", "r_path").agg(F.max("verdict").alias("verdict"))
    )
    # Both are bounded by the longest rule, not by their number.
    shape = rules.agg(
        F.collect_set(F.size(F.split("r_host", r"\."))).alias("labels"),
        F.collect_set(F.length("r_path")).alias("lengths"),
    ).first()
    host, path = url_parts(F.col("url"))
    parts = pages.select(*keep, host.alias("host"), path.alias("path"))
    labels = F.array(*map(F.lit, shape["labels"])).cast("array<int>")
    lengths = F.array(*map(F.lit, shape["lengths"])).cast("array<int>")
    names = F.split("host", r"\.")
    suffixes = F.transform(
        F.filter(labels, lambda n: n <= F.size(names)),
        lambda n: F.array_join(F.slice(names, F.size(names) - n + 1, n), "."),
    )
    prefixes = F.transform(
        F.filter(lengths, lambda n: n <= F.length("path")), lambda n: F.left("path", n)
    )
    expressions = (
        parts.where("host <> ''").select("host", "path").distinct()
        .withColumn("e_host", F.explode(suffixes))
        .withColumn("e_path", F.explode(prefixes))
        .withColumn("digest", _digest(F.col("e_host"), F.col("e_path")))
        .withColumn("short", F.left("digest", F.lit(PREFIX_HEX_DIGITS)))
        .select("host", "path", "digest", "short")
    )
    listed = rules.withColumn("r_digest", _digest(F.col("r_host"), F.col("r_path"))).withColumn(
        "short", F.left("r_digest", F.lit(PREFIX_HEX_DIGITS))
    )
    rank = F.struct(
        (F.length("r_host") + F.length("r_path")).alias("size"),
        F.length("r_host").alias("host_size"),
        F.concat("r_host", "r_path").alias("rule"),
        "verdict",
    )
    best = (
        expressions.join(listed, "short").where("digest = r_digest")
        .groupBy("host", "path").agg(F.max(rank).alias("best"))
    )
    return parts.join(best, ["host", "path"], "left").select(
        *keep,
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(DEFAULT_VERDICT)).alias("verdict"),
    )
