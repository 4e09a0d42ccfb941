"""Removal of long repeated byte strings by common-prefix interval trees.

Runs of windows that repeat as a whole are settled by their hashes (see
``repeats``). The open runs of each anchor go together into an enhanced suffix
array: suffixes in order and the common prefix of neighbours. A scan with a stack
turns it into the tree of common-prefix intervals; an interval whose occurrences
have different bytes before them is a maximal repeat with all occurrences that
the interval spans. Their union is removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from refrain.llm.common import map_batches, release, stored, unused_name
from refrain.llm.repeats import keyed_texts, settle_runs, with_runs
from refrain.llm.spans import RangeHash, Runs, Texts, anchored_runs, byte_codes

WIDTH = 200
#: Bytes of a gram; the smallest gram hash anchors a window.
GRAM = 32
#: Anchors with more different runs are split by longer common parts of their
#: windows until no group is larger.
MAX_GROUP = 500
#: Bytes of text in one suffix array; whole groups are put together up to this.
ARRAY_BYTES = 1 << 18

_MIXED = None


@dataclass
class Interval:
    """A maximal repeat: its length and where it starts in the joined texts.

    Its suffixes follow each other in order, from ``low`` to ``high``; ``starts`` is
    that part of the suffix array, so it holds all occurrences, those in longer
    repeats too. ``parent`` is the length of the next shorter common prefix, or 0.
    """

    length: int
    low: int
    high: int = 0
    parent: int = 0
    before: int | None = field(default=_MIXED, repr=False)
    starts: np.ndarray | None = field(default=None, repr=False)


def _ranks(joined: Texts, longest: int) -> list[np.ndarray]:
    """For 8, 16, 32, ... bytes: the rank of what starts at each place.

    Nothing is read beyond the end of a place's text: of two that begin alike, the
    one whose text ends first ranks first. Each array has ``longest`` more
    entries, for places beyond the end.
    """
    n = len(joined.data)
    padded = np.r_[joined.data, np.zeros(7, np.uint8)].astype(np.uint64)
    word = np.zeros(n, np.uint64)
    for i in range(8):
        word = (word << np.uint64(8)) | padded[i : i + n]
    left = np.repeat(joined.end, joined.end - joined.begin + 1) - np.arange(n)
    within = np.minimum(left, 8)
    beyond = (8 * (8 - np.maximum(within, 1))).astype(np.uint64)
    word = np.where(within > 0, (word >> beyond) << beyond, np.uint64(0))
    _, rank = np.unique(word, return_inverse=True)
    rank = rank.astype(np.int64) * 9 + within  # zeros of a text come after its end
    levels, size = [], 8
    while True:
        levels.append(np.r_[rank + 1, np.zeros(longest + 1, np.int64)])
        if size >= longest:
            return levels
        follows = np.where(left > size, levels[-1][size : size + n], 0)
        word = levels[-1][:n] * (int(levels[-1].max()) + 1) + follows
        _, rank = np.unique(word, return_inverse=True)
        rank = rank.astype(np.int64)
        size *= 2


def _common_prefix(
    data: np.ndarray, levels: list[np.ndarray], a: np.ndarray, b: np.ndarray, most: np.ndarray
) -> np.ndarray:
    """Length of the common prefix of the suffixes at a and b, at most ``most``."""
    length = np.zeros(len(a), np.int64)
    for level in reversed(range(len(levels))):
        size, rank = 8 << level, levels[level]
        same = rank[np.minimum(a + length, len(rank) - 1)] == rank[np.minimum(b + length, len(rank) - 1)]
        length[same] += size
    last = len(data) - 1
    for _ in range(7):
        same = data[np.minimum(a + length, last)] == data[np.minimum(b + length, last)]
        length[same & (length < most)] += 1
    return np.minimum(length, most)


def _scan(lengths: list[int], before: list[int]) -> Iterator[Interval]:
    """The left-diverse common-prefix intervals of suffixes in order.

    ``lengths[i]`` is the common prefix of suffixes i and i + 1, ``before[i]`` the
    byte before suffix i. The stack holds the open intervals, the longest on top; one
    is complete when a shorter common prefix comes. An interval whose suffixes all
    follow the same byte is part of one that starts a byte earlier.
    """
    stack: list[Interval] = []
    for i, said in enumerate(before):
        length = lengths[i] if i < len(lengths) else 0
        low = i
        while stack and stack[-1].length > length:
            node = stack.pop()
            if node.before != said:
                node.before = said = _MIXED
            low, node.high = node.low, i
            if said is _MIXED:
                node.parent = max(length, stack[-1].length if stack else 0)
                yield node
        if stack and stack[-1].length == length:
            if stack[-1].before != said:
                stack[-1].before = _MIXED
        elif length:
            stack.append(Interval(length, low, before=said))


def maximal_repeats(texts: list[bytes], width: int) -> tuple[Texts, list[Interval]]:
    """All maximal repeats of at least ``width`` bytes in some texts.

    A text's start counts as preceded by a byte that is nowhere else. Repeats do
    not reach over the end of a text.
    """
    joined = Texts.join(texts)
    sizes = joined.end - joined.begin
    counts = np.maximum(sizes - width + 1, 0)
    if counts.sum() < 2:
        return joined, []
    text = np.repeat(np.arange(len(texts)), counts)
    place = np.arange(counts.sum()) - (np.cumsum(counts) - counts)[text] + joined.begin[text]
    levels = _ranks(joined, int(sizes.max()))
    order = np.argsort(levels[-1][place], kind="stable")
    place, left_over = place[order], joined.end[text[order]] - place[order]
    lengths = _common_prefix(
        joined.data, levels, place[:-1], place[1:], np.minimum(left_over[:-1], left_over[1:])
    )
    before = np.where(
        np.isin(place, joined.begin), -1 - place, joined.data[np.maximum(place - 1, 0)]
    ).astype(np.int64)
    group = np.flatnonzero(np.r_[True, lengths < width])
    size = np.diff(np.r_[group, len(place)])
    diverse = np.minimum.reduceat(before, group) != np.maximum.reduceat(before, group)
    found = []
    for g, n in zip(group[diverse & (size > 1)], size[diverse & (size > 1)]):
        for interval in _scan(lengths[g : g + n - 1].tolist(), before[g : g + n].tolist()):
            interval.starts = place[g + interval.low : g + interval.high + 1]
            found.append(interval)
    return joined, found


def run_maker(width: int, gram: int) -> Callable[[list[bytes]], tuple[Runs, np.ndarray]]:
    def make(texts: list[bytes]) -> tuple[Runs, np.ndarray]:
        joined = Texts.join(texts)
        runs = anchored_runs(byte_codes(joined.data), joined.begin, joined.end, width, gram)
        return runs, joined.begin

    return make


def _repeated_spans(open_texts: DataFrame, width: int) -> DataFrame:
    """``doc_id``, ``start`` and ``length`` of the bytes that maximal repeats among
    the open runs of an anchor cover, all occurrences together."""

    def flush(rows: list[dict]) -> pa.RecordBatch:
        joined, intervals = maximal_repeats([r["bytes"] for r in rows], width)
        change = np.zeros(len(joined.data) + 1, np.int64)
        for interval in intervals:
            change[interval.starts] += 1
            change[interval.starts + interval.length] -= 1
        edges = np.flatnonzero(np.diff(np.r_[0, np.cumsum(change[:-1]) > 0, 0]))
        begin, end = edges[::2], edges[1::2]
        owner = np.searchsorted(joined.begin, begin, "right") - 1
        made = [
            {"doc_id": rows[o]["doc_id"], "start": rows[o]["start"] + at, "length": length}
            for o, at, length in zip(
                owner.tolist(), (begin - joined.begin[owner]).tolist(), (end - begin).tolist()
            )
        ]
        return pa.RecordBatch.from_pylist(made, schema=target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                if rows and all(row[c] == rows[-1][c] for c in ("anchor", "doc_id", "start")):
                    continue  # of a row that repeats id and text
                if size > ARRAY_BYTES and row["anchor"] != rows[-1]["anchor"]:
                    yield flush(rows)
                    rows, size = [], 0
                rows.append(row)
                size += len(row["bytes"])
        if rows:
            yield flush(rows)

    key = pa.struct([("doc_id", pa.int64()), ("text_hash", pa.int64())])
    target = pa.schema([("doc_id", key), ("start", pa.int32()), ("length", pa.int32())])
    return (
        open_texts.repartition("anchor").sortWithinPartitions("anchor", "doc_id", "start")
        .mapInArrow(run, "doc_id struct<doc_id:bigint,text_hash:bigint>, start int, length int")
    )


def _anchor_place(data: bytes, anchor: int, gram: int) -> int:
    """Where in a run its anchor starts."""
    place = np.arange(len(data) - gram + 1)
    hashes = RangeHash(byte_codes(np.frombuffer(data, np.uint8)))(place, place + gram)
    return int(np.argmax(hashes.view(np.int64) == anchor))


def _split_groups(
    rows: DataFrame, width: int, gram: int, max_group: int
) -> tuple[list[DataFrame], list[DataFrame]]:
    """Large groups split until each has at most ``max_group`` different runs.

    A window is told by how many bytes ``i`` it starts before its anchor. Each step
    halves the range of i of a group; all windows of a half share its core, the
    bytes that every one of them has, so equal windows stay together when the
    core's hash joins the key. Rows under a key of their own hold no repeat and go;
    equal rows repeat as a whole. In a range of one the core is the window, so the
    halving ends. ``rows`` has ``doc_id``, ``anchor``, ``start``, ``at`` (the anchor's
    place) and ``bytes``. Returns spans that repeat as a whole, and small groups.
    """
    whole, small = [], []
    rows = rows.select("doc_id", F.col("anchor").alias("key"), "start", "at", "bytes")
    rows = rows.withColumn("low", F.lit(0)).withColumn("high", F.lit(width - gram))
    while not rows.isEmpty():
        middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
        halves = rows.withColumn(
            "half",
            F.explode(
                F.array(
                    F.struct(F.col("low").alias("x"), middle.alias("y")),
                    F.struct((middle + 1).alias("x"), F.col("high").alias("y")),
                )
            ),
        ).where("half.x <= half.y")
        first = F.greatest("half.x", F.col("at") - F.length("bytes") + width)  # the nearest window
        last = F.least("half.y", F.col("at"))
        halves = (
            halves.withColumn("near", first).withColumn("far", last).where("near <= far")
            .select(
                "doc_id", "key", (F.col("start") + F.col("at") - F.col("far")).alias("start"),
                F.col("far").alias("at"), F.col("half.x").alias("low"), F.col("half.y").alias("high"),
                F.substring("bytes", F.col("at") - F.col("far") + 1, F.col("far") - F.col("near") + width).alias("bytes"),
            )
            .withColumn(
                "key",
                F.xxhash64(
                    "key", "low",
                    F.substring("bytes", F.col("at") - F.col("low") + 1, width - F.col("high") + F.col("low")),
                ),
            )
            .withColumn("content", F.xxhash64("at", "bytes"))
        )
        contents = stored(
            halves.groupBy("key", "content").agg(
                F.count("*").alias("copies"), F.min(F.struct("doc_id", "start")).alias("first")
            ),
            "half-contents",
        )
        sizes = stored(contents.groupBy("key").agg(F.count("*").alias("contents")), "half-sizes")
        # All rows of a step go into one table, of which the next step and the results
        # are parts: so no step's joins are planned again with those of others, and few
        # files are made. (For each, Hadoop may start processes.)
        wanted = contents.join(sizes, "key").where("contents > 1 OR copies > 1")
        told = (F.col("contents") > 1) & (F.struct("doc_id", "start") == F.col("first"))
        step = stored(
            halves.join(wanted, ["key", "content"]).withColumn("told", told).where("told OR copies > 1")
            .select(
                "doc_id", "key", "start", "at", "low", "high", "copies", "contents", "told",
                F.length("bytes").alias("length"), F.when(F.col("told"), F.col("bytes")).alias("bytes"),
            ),
            "told-halves",
        )
        release(contents, sizes)
        whole.append(step.where("copies > 1").select("doc_id", "start", "length"))
        small.append(
            step.where(F.col("told") & (F.col("contents") <= max_group)).select(
                "doc_id", F.col("key").alias("anchor"), "start", "bytes"
            )
        )
        rows = step.where(F.col("told") & (F.col("contents") > max_group)).select(
            "doc_id", "key", "start", "at", "bytes", "low", "high"
        )
    return whole, small


RESULT = "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"
_SPAN = "array<struct<start:int,length:int>>"


def _result(data: bytes, spans: list[tuple[int, int]], with_text: bool) -> tuple:
    change = np.zeros(len(data) + 1, np.int64)
    for start, length in spans:
        change[start] += 1
        change[start + length] -= 1
    removed = np.cumsum(change[:-1]) > 0
    kept = np.frombuffer(data, np.uint8)[~removed].tobytes()
    runs = int(np.count_nonzero(removed & ~np.r_[False, removed[:-1]])) if len(data) else 0
    return (
        len(data), int(removed.sum()), runs, hashlib.sha256(kept).hexdigest(), kept if with_text else None
    )


def _columns(rows: list[tuple], names: list[str]) -> dict[str, list]:
    return {name: [row[i] for row in rows] for i, name in enumerate(names)}


def remove_repeats(
    docs: DataFrame, width: int = WIDTH, gram: int = GRAM, max_group: int = MAX_GROUP,
    with_text: bool = False, carried: list[str] | None = None,
) -> DataFrame:
    """Bytes left in each document when repeated byte strings are removed.

    Removes each byte covered by a string of ``width`` bytes that also starts
    anywhere else, in the same document too; strings are judged on the input and
    never reach over documents. Returns ``doc_id``, ``n_bytes``, ``n_removed``,
    ``n_spans`` (maximal removed runs), ``kept_sha256`` and with ``with_text`` the
    ``kept`` bytes. NULL and empty texts have no bytes; NULL ids stay NULL; rows that
    repeat id and text are documents of their own, so each removes the other;
    other columns of ``docs`` are ignored, but the ``carried`` ones come back in a
    struct ``rest``.
    """
    texts = keyed_texts(docs, carried)
    rest = ["rest"] if carried else []
    along = f", rest {texts.schema['rest'].dataType.simpleString()}" if carried else ""
    lists, read_from = settle_runs(texts, run_maker(width, gram), keep_first=False)
    names = [f.split()[0] for f in RESULT.split(", ")]

    def settle(batch: pa.RecordBatch) -> dict:
        """Results of documents without open runs; the others wait."""
        rows = []
        columns = (batch[c].to_pylist() for c in ("text", "closed", "open"))
        for text, closed, opened in zip(*columns):
            spans = [(r["start"], r["count"] - 1 + width) for r in closed or []]
            if opened:
                held = [{"start": a, "length": n} for a, n in spans]
                rows.append((text, held, opened) + (None,) * len(names))
            else:
                found = _result(text.encode("utf-8", "surrogatepass"), spans, with_text)
                rows.append((None,) * 3 + found)
        made = _columns(rows, ["text", "closed", "open", *names])
        return made | {name: batch[name] for name in rest}

    half = stored(
        map_batches(
            with_runs(texts, lists), settle,
            f"text string, closed {_SPAN}, "
            "open array<struct<start:int,count:int,copies:bigint,contents:bigint,anchor:bigint>>, "
            f"{RESULT}{along}",
        ),
        "half-done",
    )
    release(*read_from)
    waiting = half.where("text IS NOT NULL")

    def cut(batch: pa.RecordBatch) -> dict:
        rows, seen = [], set()
        columns = (batch[c].to_pylist() for c in ("doc_id", "text", "open"))
        for i, (key, text, runs) in enumerate(zip(*columns)):
            key = key["doc_id"], key["text_hash"]
            if key in seen:  # rows that repeat id and text tell the same
                continue
            seen.add(key)
            data = text.encode("utf-8", "surrogatepass")
            for r in runs:
                part = data[r["start"] : r["start"] + r["count"] - 1 + width]
                large = r["contents"] > max_group
                at = _anchor_place(part, r["anchor"], gram) if large else 0
                rows.append((i, r["anchor"], large, r["start"], at, part))
        return _columns(rows, ["row", "anchor", "large", "start", "at", "bytes"])

    open_texts = map_batches(
        waiting.select("doc_id", "text", "open"), cut,
        "anchor bigint, large boolean, start int, at int, bytes binary",
    )
    large = open_texts.where("large").drop("large").dropDuplicates(["doc_id", "anchor", "start"])
    large = stored(large, "large-groups")
    groups = [open_texts.where("NOT large").select("doc_id", "anchor", "start", "bytes")]
    whole, split = _split_groups(large, width, gram, max_group)
    release(large)
    repeated = _repeated_spans(reduce(DataFrame.unionByName, groups + split), width)
    spans = (
        reduce(DataFrame.unionByName, [repeated, *whole])
        .groupBy(F.col("doc_id").alias("key"))
        .agg(F.collect_set(F.struct("start", "length")).alias("spans"))
    )

    def finish(batch: pa.RecordBatch) -> dict:
        rows = [
            _result(
                text.encode("utf-8", "surrogatepass"),
                [(s["start"], s["length"]) for s in (closed or []) + (spans or [])],
                with_text,
            )
            for text, closed, spans in zip(*(batch[c].to_pylist() for c in ("text", "closed", "spans")))
        ]
        return _columns(rows, names) | {name: batch[name] for name in rest}

    finished = map_batches(
        waiting.select("doc_id", "text", "closed", *rest)
        .join(spans, F.col("doc_id") == F.col("key"), "left").drop("key"),
        finish, RESULT + along,
    )
    results = half.where("text IS NULL").select("doc_id", *names, *rest).unionByName(finished)
    return results.select("doc_id.doc_id", *(names if with_text else names[:-1]), *rest)


def cut_repeats(docs: DataFrame, **options) -> DataFrame:
    """``docs``, all columns, with repeated byte strings cut out of ``text``.

    Where a cut falls inside a character its remaining bytes go too. ``n_chars``, if
    there, is counted anew. Texts that are NULL stay NULL; a text that is cut out
    whole is empty; no row is dropped; rows that repeat id and text remove each
    other; columns may have any names; an empty table stays empty.
    """
    mark = unused_name("text_is_null", docs)
    carried = [c for c in docs.columns if c != "text"] + [mark]
    marked = docs.withColumn(mark, F.col("text").isNull())
    cut = remove_repeats(marked, with_text=True, carried=carried, **options)
    text = F.when(~F.col("rest")[mark], _whole_characters("kept"))
    columns = {c: F.col("rest")[c] for c in docs.columns if c != "text"} | {"text": text}
    if "n_chars" in columns:
        columns["n_chars"] = F.length(text).cast(docs.schema["n_chars"].dataType)
    return cut.select(*(columns[c].alias(c) for c in docs.columns))


@F.pandas_udf(StringType())
def _whole_characters(kept: pd.Series) -> pd.Series:
    return kept.map(lambda data: bytes(data).decode("utf-8", "ignore"))
