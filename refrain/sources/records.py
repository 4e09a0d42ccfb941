r"""CSV records with line breaks inside quotes, read once and by many tasks.

Spark splits a file at line feeds, so a split may begin inside a quoted field. Each
task walks the lines of its splits, joins the lines of a record, and takes from the
first lines whether its split begins inside quotes: the wrong reading soon has text
where a quote must end a field, or rows of another width. What stands before the
first record of a split and what is open at its end goes into one row about the
split. These rows, one for each split, are then put in order of their place in the
file: every split must begin as the one before it ends, and the open pieces in
between make the records that cross borders. If a split began otherwise than its
task took it, the ends of all splits under both readings are worked out, scanned for
the true beginnings, and the file is read again with those.

A quote opens a field only at its start; inside, two quotes stand for one. Records
end with LF or CR LF.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from refrain.schemas import free_name
from refrain.session import scratch_path

QUOTE, COMMA = b'"', b","

#: A line that ends outside quotes if it begins outside.
_FIELD = r'(?:"(?:[^"]|"")*"(?:[^",][^,]*)?|[^",][^,]*|)'
_WHOLE = rf"^{_FIELD}(?:,{_FIELD})*$"
_BLANK = r"^[\x00-\x20]*$"

#: Lines by which the beginning of a split is judged.
JUDGED = 1_000

#: What a task says about a split: its place, whether it begins and ends inside
#: quotes, the text before its first record, and the text of the record open at its end.
SPLIT = "struct<file: string, start: bigint, opens: boolean, closes: boolean, head: binary, tail: binary>"

_UNCLOSED = "a quoted field is never closed in "
_HEADER = "the header of a file does not agree with the others: "

State = bool
Begins = Callable[[str, int], State | None]


def ends_inside(line: bytes, inside: State) -> State:
    """Whether a line that begins inside quotes, or not, ends inside."""
    at = 0
    while True:
        if not inside:
            if line[at : at + 1] == QUOTE:
                inside, at = True, at + 1
                continue
        else:
            at = line.find(QUOTE, at)
            if at < 0:
                return True
            if line[at + 1 : at + 2] == QUOTE:
                at += 2
                continue
            inside = False
        at = line.find(COMMA, at) + 1
        if not at:
            return False


def _oddities(lines: list[bytes], inside: State, width: int) -> int:
    """How much speaks against lines beginning this way."""
    odd, fields, whole = 0, 1, not inside
    for line in lines:
        line, at = line.removesuffix(b"\r"), 0
        if not line and not inside:
            continue
        while True:
            if inside:
                at = line.find(QUOTE, at)
                if at < 0:
                    break
                if line[at + 1 : at + 2] == QUOTE:
                    at += 2
                    continue
                inside, at = False, at + 1
                odd += line[at : at + 1] not in (b"", COMMA)
            elif line[at : at + 1] == QUOTE:
                inside, at = True, at + 1
                continue
            comma = line.find(COMMA, at)
            odd += line.count(QUOTE, at, comma if comma >= 0 else len(line))
            if comma < 0:
                break
            fields, at = fields + 1, comma + 1
        if not inside:
            odd += whole and fields != width
            fields, whole = 1, True
    return odd


def begins_inside(lines: list[bytes], width: int) -> State:
    return _oddities(lines, True, width) < _oddities(lines, False, width)


class _Split:
    """The records of one split, whose lines come in order."""

    def __init__(self, file: str, start: int, columns: list[str], begins: State | None):
        self.file, self.start, self.columns = file, start, columns
        self.begins = False if start == 0 else begins
        self.inside = self.begins
        self.header = start == 0
        self.judged: list[bytes] = []
        # Lines of the record that is open, and those before the first record.
        self.open: list[bytes] = []
        self.head: bytes | None = None
        self.entered = False

    def add(self, lines: pa.Array) -> list[pa.Array]:
        """Whole records that end in ``lines``."""
        if self.begins is None:
            self.judged += lines.slice(0, JUDGED - len(self.judged)).to_pylist()
            self.begins = self.inside = begins_inside(self.judged, len(self.columns))
            self.entered = not self.inside
        elif not self.inside:
            self.entered = True
        whole = pc.match_substring_regex(lines, _WHOLE).to_numpy(zero_copy_only=False)
        broken = np.append(np.flatnonzero(~whole), len(lines))
        out, at = [], 0
        while at < len(lines):
            if not self.inside:
                until = int(broken[np.searchsorted(broken, at)])
                if until > at:
                    out += self._records(lines.slice(at, until - at))
                at = until
                if at < len(lines):
                    # The expression and the walk agree on what a broken line is.
                    self.open, self.inside = [lines[at].as_py()], True
                    at += 1
                continue
            line = lines[at].as_py()
            at += 1
            self.open.append(line)
            if not ends_inside(line, True):
                self.inside = False
                text = b"\n".join(self.open)
                self.open = []
                if self.entered:
                    out += self._records(pa.array([text], pa.binary()))
                else:
                    self.head, self.entered = text, True
        return out

    def _records(self, found: pa.Array) -> list[pa.Array]:
        found = found.filter(pc.invert(pc.match_substring_regex(found, _BLANK)))
        if self.header and len(found):
            self._check_header(found[0].as_py())
            self.header, found = False, found.slice(1)
        if not len(found):
            return []
        if pc.any(pc.ends_with(found, pattern=b"\r")).as_py():
            found = pa.array([x.removesuffix(b"\r") for x in found.to_pylist()], pa.binary())
        return [found]

    def _check_header(self, record: bytes) -> None:
        text = record.decode("utf-8", "replace").removeprefix("﻿").removesuffix("\r")
        names = next(csv.reader(io.StringIO(text, newline="")))
        folded = [n.lower() for n in names]
        # As Spark names blank and repeated columns.
        names = [f"_c{i}" if not n else f"{n}{i}" if folded.count(n.lower()) > 1 else n for i, n in enumerate(names)]
        if [n.lower() for n in names] != [c.lower() for c in self.columns]:
            raise ValueError(f"{_HEADER}{text[:200]}")

    def row(self) -> dict:
        if self.header and self.open:
            raise ValueError(f"{_HEADER}it is longer than a split of {self.file}")
        rest = b"\n".join(self.open) if self.open else None
        head, tail = (self.head, rest) if self.entered else (rest, None)
        return {
            "file": self.file, "start": self.start, "opens": bool(self.begins),
            "closes": bool(self.inside), "head": head, "tail": tail,
        }


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, pa.Array]]:
    """The lines of a batch by split."""
    starts = batch["start"].to_numpy()
    files = batch["file"].dictionary_encode()
    keys = files.indices.to_numpy()
    edges = np.flatnonzero((starts[1:] != starts[:-1]) | (keys[1:] != keys[:-1])) + 1
    edges = [0, *edges.tolist(), batch.num_rows]
    for a, b in zip(edges, edges[1:]):
        if b > a:
            yield files.dictionary[int(keys[a])].as_py(), int(starts[a]), batch["value"].slice(a, b - a)


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    lines = spark.read.option("lineSep", "\n").text(path)
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")]
    return lines.select(F.col("value").cast("binary").alias("value"), *place)


def _scan(spark: SparkSession, path: str | list[str], columns: list[str], begins: Begins) -> DataFrame:
    """``record`` of every record within a split, and a row with ``split`` for each."""
    split_type = pa.struct(
        [("file", pa.string()), ("start", pa.int64()), ("opens", pa.bool_()), ("closes", pa.bool_()),
         ("head", pa.binary()), ("tail", pa.binary())]
    )
    schema = pa.schema([("record", pa.binary()), ("split", split_type)])

    def rows(records: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([records, pa.nulls(len(records), split_type)], schema=schema)

    def about(split: _Split) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.nulls(1, pa.binary()), pa.array([split.row()], split_type)], schema=schema
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = None
        for batch in batches:
            for file, start, lines in _runs(batch):
                if split is None or (split.file, split.start) != (file, start):
                    if split:
                        yield about(split)
                    split = _Split(file, start, columns, begins(file, start))
                for found in split.add(lines):
                    yield rows(found)
        if split:
            yield about(split)

    return _lines(spark, path).mapInArrow(run, f"record binary, split {SPLIT}")


def _true_beginnings(spark: SparkSession, path: str | list[str]) -> set[tuple[str, int]]:
    """The splits that begin inside quotes, by a scan over the ends of all splits.

    A split makes one end of either beginning, or keeps it, or turns it round. The
    beginning is the end that the last split made which has but one, turned round by
    those since. One row for each split is shuffled; those that begin inside quotes
    come to the driver, of the size of their names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ends = None, (False, True)

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(
                [{"file": key[0], "start": key[1], "outside": ends[0], "inside": ends[1]}]
            )

        for batch in batches:
            for file, start, lines in _runs(batch):
                if key != (file, start):
                    if key:
                        yield row()
                    key, ends = (file, start), (False, True)
                quoted = lines.filter(pc.match_substring(lines, '"'))
                for line in quoted.to_pylist():
                    ends = tuple(ends_inside(line, end) for end in ends)
        if key:
            yield row()

    ends = _lines(spark, path).mapInArrow(run, "file string, start bigint, outside boolean, inside boolean")
    upto = Window.partitionBy("file").orderBy("start")
    before = upto.rowsBetween(Window.unboundedPreceding, -1)
    fixed, turned = F.col("outside") == F.col("inside"), F.col("outside") & ~F.col("inside")
    ends = ends.withColumn("turns", F.count_if(turned).over(upto))
    made = F.coalesce(F.last(F.when(fixed, F.col("outside")), True).over(before), F.lit(False))
    since = F.coalesce(F.last("turns").over(before), F.lit(0)) - F.coalesce(
        F.last(F.when(fixed, F.col("turns")), True).over(before), F.lit(0)
    )
    found = ends.select("file", "start", (made != (since % 2 == 1)).alias("inside")).where("inside")
    return {(r.file, r.start) for r in found.collect()}


def _crossing(splits: DataFrame) -> DataFrame:
    """``record`` of the records that lie in several splits, in any number of them."""
    order = Window.partitionBy("file").orderBy("start", "place")
    pieces = splits.select(
        "file",
        "start",
        F.posexplode(F.array("head", "tail")).alias("place", "text"),
    ).where(F.col("text").isNotNull())
    pieces = pieces.withColumn("record", F.count_if(F.col("place") == 1).over(order))
    joined = pieces.groupBy("file", "record").agg(
        F.array_sort(F.collect_list(F.struct("start", "place", "text"))).alias("pieces")
    )
    text = F.array_join(F.transform("pieces", lambda p: p["text"].cast("string")), "\n")
    return joined.select(F.regexp_replace(text, r"\r\z", "").cast("binary").alias("record"))


def stored_records(
    spark: SparkSession, path: str | list[str], columns: list[str], made: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """What ``made`` makes of the ``record`` of all records, header lines left out.

    The raw text is scanned once, in a job that this call runs; its rows are stored
    in a scratch dataset of Parquet. ``made`` must keep other columns and may take any
    names for its own but those that ``free_name`` finds beside ``columns``. A file
    that ends inside quotes, or has another header than ``columns``, raises.
    """
    split = free_name("split", columns)
    about = F.col(split)
    begins: Begins = lambda file, start: None
    known = False

    def again() -> Begins:
        inside = _true_beginnings(spark, path)
        return lambda file, start: (file, start) in inside

    while True:
        folder = scratch_path(spark, "records")
        scanned = _scan(spark, path, columns, begins).withColumnRenamed("split", split)
        try:
            made(scanned).write.parquet(f"{folder}/within")
        except PySparkException as fault:
            # Rows that raise may come of a split that was begun the wrong way.
            if known or isinstance(fault, AnalysisException):
                raise
            begins, known = again(), True
            continue
        stored = spark.read.parquet(f"{folder}/within")
        splits = stored.where(about.isNotNull()).select(f"{split}.*")
        order = Window.partitionBy("file").orderBy("start")
        joint = splits.select(
            "file",
            (F.col("opens") != F.coalesce(F.lag("closes").over(order), F.lit(False))).alias("wrong"),
            (F.col("closes") & F.lead("start").over(order).isNull()).alias("unclosed"),
            F.coalesce("head", "tail").isNotNull().alias("pieces"),
        )
        found = joint.agg(
            F.max("wrong"), F.max_by("file", "unclosed"), F.max("unclosed"), F.max("pieces")
        ).first()
        if found and found[0] and not known:
            begins, known = again(), True
            continue
        if found and found[2]:
            raise ValueError(f"{_UNCLOSED}{found[1]}")
        if found and found[3]:
            pieces = splits.where("head IS NOT NULL OR tail IS NOT NULL")
            crossing = _crossing(pieces).withColumn(split, F.lit(None).cast(SPLIT))
            made(crossing).write.parquet(f"{folder}/crossing")
            stored = spark.read.schema(stored.schema).parquet(f"{folder}/within", f"{folder}/crossing")
        return stored.where(about.isNull()).drop(split)
