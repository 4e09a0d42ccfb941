"""Quality rules by the frequency of lines across documents.

Every line is normalised (words in lower case, one space between) and hashed.
For each host the documents that hold a line are counted, every copy of a text
among them. Lines in more than a host's limit are removed, and a document that
loses more than a set share of its words is rejected. Base rules on words and
repeated windows come before.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refrain.llm.common import map_texts, stored
from refrain.llm.spans import (
    LOWER,
    RangeHash,
    Texts,
    Words,
    byte_codes,
    chunks,
    covered,
    mix,
    window_starts,
)

#: A line is removed if it is in more documents of a host than both of these allow,
MIN_DOCS = 10
MAX_SHARE = 0.05
#: or in more than this many, however large the host is.
MAX_DOCS = 200
#: A document is depleted if more than this share of its words is removed.
MAX_REMOVED = 0.5
MIN_WORDS = 50
#: Percent of words in repeated windows of three.
MAX_REPEATED = 50
WINDOW = 3

#: Fixed value: the symbols that the rules count.
SYMBOLS = b"#*$%&|<>"

_IS_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))
_STARTS_CHARACTER = (np.arange(256) & 0xC0) != 0x80

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_MEASURED = (
    ", ".join(f"{c} bigint" for c in COUNTS)
    + ", lines array<bigint>, line_words array<bigint>"
)


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    totals = np.r_[0, np.cumsum(values, dtype=np.int64)]
    return totals[first[1:]] - totals[first[:-1]]


def _measure(texts: list[bytes]) -> tuple[dict[str, np.ndarray], list[np.ndarray], list[np.ndarray]]:
    """Counts of each text; its distinct normalised lines and their words."""
    joined, n = Texts.join(texts), len(texts)
    data, bounds = joined.data, np.r_[joined.begin, len(joined.data)]
    words = Words.of(joined)
    in_word = np.zeros(len(data) + 1, np.int8)
    in_word[words.start] += 1
    in_word[words.end] -= 1
    in_word = np.cumsum(in_word[:-1], dtype=np.int8) > 0

    bytes_hash = RangeHash(byte_codes(data))
    of_word = bytes_hash(words.start, words.end)
    starts, text = window_starts(words.first[:-1], words.first[1:], WINDOW)
    windows = RangeHash(of_word)(starts, starts + WINDOW) ^ mix(text.astype(np.uint64))
    _, place, times = np.unique(windows, return_inverse=True, return_counts=True)
    repeated = covered(starts[times[place] > 1], WINDOW, len(of_word))

    line_end = np.flatnonzero(data == 10)  # the joining line feed ends the last line
    line_start = np.r_[0, line_end[:-1] + 1]
    first_word = np.searchsorted(words.start, np.r_[line_start, len(data)])
    has_word = np.diff(first_word) > 0
    line_start, line_end = line_start[has_word], line_end[has_word]
    from_word, to_word = first_word[:-1][has_word], first_word[1:][has_word]
    line_text = np.searchsorted(joined.begin, line_start, "right") - 1
    exact = bytes_hash(line_start, line_end) ^ mix(line_text.astype(np.uint64))
    _, kept = np.unique(exact, return_index=True)
    lines = np.bincount(line_text, minlength=n)

    lower = RangeHash(byte_codes(LOWER[data]))(words.start, words.end)
    normal = RangeHash(lower)(from_word, to_word).view(np.int64)
    order = np.lexsort((normal, line_text))
    normal, line_text, size = normal[order], line_text[order], (to_word - from_word)[order]
    new = np.ones(len(normal), bool)
    new[1:] = (normal[1:] != normal[:-1]) | (line_text[1:] != line_text[:-1])
    at = np.flatnonzero(new)
    split = np.searchsorted(line_text[at], np.arange(1, n))
    line_words = np.add.reduceat(size, at) if len(at) else size
    counts = {
        "n_words": np.diff(words.first),
        "word_chars": _sums(in_word & _STARTS_CHARACTER[data], bounds),
        "n_symbols": _sums(_IS_SYMBOL[data], bounds),
        "n_dup_lines": lines - np.bincount(np.searchsorted(joined.begin, line_start[kept], "right") - 1, minlength=n),
        "n_repeat_words": _sums(repeated, words.first),
    }
    return counts, np.split(normal[at], split), np.split(line_words, split)


def measure(docs: DataFrame, host: str) -> DataFrame:
    """``doc_id``, ``host``, ``text_hash``, the COUNTS, and the distinct lines of
    every row with the words they hold in all."""

    def run(texts: list[str | None]) -> dict:
        made = {c: [] for c in (*COUNTS, "lines", "line_words")}
        for _, chunk in chunks(texts):
            counts, lines, sizes = _measure(chunk)
            for c in COUNTS:
                made[c].append(counts[c])
            made["lines"] += lines
            made["line_words"] += sizes
        for c in COUNTS:
            made[c] = np.concatenate(made[c] or [np.empty(0, np.int64)])
        return made

    keyed = docs.select(
        F.struct(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col(host).cast("string").alias("host"),
            F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"),
        ).alias("doc_id"),
        "text",
    )
    measured = map_texts(keyed, run, _MEASURED, "struct<doc_id:bigint,host:string,text_hash:bigint>")
    return measured.select("doc_id.*", *(c for c in measured.columns if c != "doc_id"))


def frequent_lines(
    measured: DataFrame, min_docs: int, max_share: float, max_docs: int
) -> tuple[DataFrame, DataFrame]:
    """Every line of every distinct text of a host, and those above the limit.

    Copies of a text are merged before the shuffle and counted as ``copies``.
    """
    lines = (
        measured.select("host", "text_hash", F.explode(F.arrays_zip("lines", "line_words")).alias("l"))
        .select("host", "text_hash", F.col("l.lines").alias("line"), F.col("l.line_words").alias("words"))
        .groupBy("host", "line", "text_hash")
        .agg(F.max("words").alias("words"), F.count("*").alias("copies"))
    )
    lines = stored(lines, "host-lines")
    hosts = measured.groupBy("host").agg(F.count("*").alias("docs"))
    held = lines.groupBy("host", "line").agg(F.sum("copies").alias("n_docs")).where(
        F.col("n_docs") > min(min_docs, max_docs)
    )
    above = held.join(hosts, held["host"].eqNullSafe(hosts["host"])).where(
        (F.col("n_docs") > max_docs)
        | (F.col("n_docs") > min_docs) & (F.col("n_docs") > max_share * F.col("docs"))
    )
    return lines, stored(above.select(held["host"], "line", "n_docs"), "frequent-lines")


def judge_lines(
    docs: DataFrame, host: str, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE,
    max_docs: int = MAX_DOCS,
) -> DataFrame:
    """Every row of ``docs`` (``doc_id``, ``text`` and a host column) judged.

    Returns ``doc_id``, COUNTS, ``base_failed``, ``n_line_words_removed``, the
    hashes of the ``removed_lines`` and ``kept``. A NULL or empty text has no word
    and fails the base rules; NULL hosts count as one host; NULL ids stay NULL;
    repeated rows each get a row and each count as a document; other columns of
    ``docs`` are ignored; an empty table gives none.
    """
    measured = stored(measure(docs, host), "measured")
    lines, frequent = frequent_lines(measured, min_docs, max_share, max_docs)
    removed = (
        lines.alias("a").join(
            frequent.alias("b"),
            F.col("a.host").eqNullSafe(F.col("b.host")) & (F.col("a.line") == F.col("b.line")),
        )
        .groupBy("a.host", "text_hash")
        .agg(F.sum("words").alias("words"), F.collect_list("a.line").alias("removed_lines"))
        .select(F.col("host").alias("r_host"), F.col("text_hash").alias("r_hash"), "words", "removed_lines")
    )
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words")
    )
    lost = F.coalesce("words", F.lit(0)).cast("long")
    return (
        measured.drop("lines", "line_words")
        .join(removed, F.col("host").eqNullSafe(F.col("r_host")) & (F.col("text_hash") == F.col("r_hash")), "left")
        .select(
            "doc_id", *COUNTS, base_failed.alias("base_failed"),
            lost.alias("n_line_words_removed"), "removed_lines",
            (~base_failed & (lost <= MAX_REMOVED * F.col("n_words"))).alias("kept"),
        )
    )
