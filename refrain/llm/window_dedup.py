"""Substring deduplication by Rabin-Karp hashes of fixed-length token windows.

Every window of WIDTH words is hashed and counted over the corpus; windows that
start earlier elsewhere are merged into maximal intervals and their words
removed. Windows are counted as runs first (see ``repeats``); the hashes of single
windows are counted only where different runs share an anchor.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refrain.llm.common import map_batches, release, stored
from refrain.llm.repeats import keyed_texts, settle_runs, starts_of, with_runs
from refrain.llm.spans import (
    RangeHash,
    Runs,
    Texts,
    Words,
    anchored_runs,
    byte_codes,
    chunks,
    covered,
)

WIDTH = 20
#: Words of a gram; the smallest gram hash anchors a window.
GRAM = 5


def _word_hashes(texts: list[bytes]) -> tuple[Words, np.ndarray, Texts]:
    joined = Texts.join(texts)
    words = Words.of(joined)
    return words, RangeHash(byte_codes(joined.data))(words.start, words.end), joined


def run_maker(width: int, gram: int) -> Callable[[list[bytes]], tuple[Runs, np.ndarray]]:
    def make(texts: list[bytes]) -> tuple[Runs, np.ndarray]:
        words, hashes, _ = _word_hashes(texts)
        return anchored_runs(hashes, words.first[:-1], words.first[1:], width, gram), words.first[:-1]

    return make


def kept_text(words: list[bytes], removed: np.ndarray) -> bytes:
    return b" ".join(w for w, gone in zip(words, removed) if not gone)


_WORD_GAPS = bytes([9, 10, 11, 12, 13, 32])
_TO_SPACE = bytes.maketrans(_WORD_GAPS, b" " * len(_WORD_GAPS))


def split_words(data: bytes) -> list[bytes]:
    return data.translate(_TO_SPACE).split()


RESULT = "n_words bigint, n_removed bigint, kept_sha256 string, kept binary"


def _result(data: bytes, starts: np.ndarray, width: int, with_text: bool) -> tuple:
    words = split_words(data)
    removed = covered(starts, width, len(words))
    kept = kept_text(words, removed)
    return (
        len(words), int(removed.sum()), hashlib.sha256(kept).hexdigest(), kept if with_text else None
    )


def _columns(rows: list[tuple], names: list[str]) -> dict[str, list]:
    return {name: [row[i] for row in rows] for i, name in enumerate(names)}


def remove_repeats(
    docs: DataFrame, width: int = WIDTH, gram: int = GRAM, with_text: bool = False
) -> DataFrame:
    """Words left in each document when repeated windows are removed.

    Removes each word covered by a window of ``width`` words whose sequence also
    starts earlier: in a smaller document (by id, then text hash; a NULL id is the
    smallest) or further left in the same one. Windows are judged on the input.
    Returns ``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256`` of the kept words
    joined by one space, and with ``with_text`` these bytes as ``kept``. NULL and
    empty texts have no words; rows that repeat both id and text are one document
    and so do not remove each other, each gets its row; other columns of ``docs``
    are ignored.
    """
    texts = keyed_texts(docs)
    lists, read_from = settle_runs(texts, run_maker(width, gram), keep_first=True)
    names = [f.split()[0] for f in RESULT.split(", ")]

    def settle(batch: pa.RecordBatch) -> dict:
        """Results of documents without open runs; the open windows of the others."""
        data, opened = batch["text"].to_pylist(), batch["open"].to_pylist()
        rows = []
        hashes: dict[int, np.ndarray] = {}
        waiting = [i for i, runs in enumerate(opened) if runs]
        for first, chunk in chunks([data[i] for i in waiting]):
            words, of_word, _ = _word_hashes(chunk)
            ranges = RangeHash(of_word)
            for j in range(len(chunk)):
                i = waiting[first + j]
                at = starts_of(opened[i]) + words.first[j]
                hashes[i] = ranges(at, at + width).view(np.int64)
        for i, (text, closed) in enumerate(zip(data, batch["closed"].to_pylist())):
            at = starts_of(closed)
            if i in hashes:
                rows.append((text, at.tolist(), hashes[i], starts_of(opened[i])) + (None,) * 4)
            else:
                rows.append((None,) * 4 + _result(text.encode("utf-8", "surrogatepass"), at, width, with_text))
        return _columns(rows, ["text", "closed", "hashes", "starts", *names])

    half = map_batches(
        with_runs(texts, lists), settle,
        f"text string, closed array<int>, hashes array<bigint>, starts array<int>, {RESULT}",
    )
    half = stored(half, "half-done")
    release(*read_from)
    waiting = half.where("text IS NOT NULL")
    windows = waiting.select(
        "doc_id", F.explode(F.arrays_zip("hashes", "starts")).alias("w")
    ).select("doc_id", F.col("w.hashes").alias("hash"), F.col("w.starts").alias("start"))
    place = F.struct("doc_id", "start")
    firsts = stored(
        windows.groupBy("hash").agg(F.min(place).alias("first"), F.count("*").alias("n"))
        .where("n > 1").select("hash", "first"),
        "first-windows",
    )
    later = (
        windows.join(firsts, "hash").where(place != F.col("first"))
        .groupBy(F.col("doc_id").alias("key")).agg(F.collect_set("start").alias("later"))
    )

    def finish(batch: pa.RecordBatch) -> dict:
        rows = [
            _result(text.encode("utf-8", "surrogatepass"), np.array((closed or []) + (later or []), np.int64), width, with_text)
            for text, closed, later in zip(*(batch[c].to_pylist() for c in ("text", "closed", "later")))
        ]
        return _columns(rows, names)

    finished = map_batches(
        waiting.select("doc_id", "text", "closed")
        .join(later, F.col("doc_id") == F.col("key"), "left").drop("key"),
        finish, RESULT,
    )
    results = half.where("text IS NULL").select("doc_id", *names).unionByName(finished)
    return results.select("doc_id.doc_id", *(names if with_text else names[:-1]))
