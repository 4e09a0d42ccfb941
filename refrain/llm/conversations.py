"""Least edits that make the turns of a conversation alternate.

A conversation is whole if its role initials read ``(s?(ua)+)?``. Its turns are
aligned to the target strings of that grammar by Wagner-Fischer: keep a turn (0),
give it another role (1), delete it (2), insert an empty one (5), and 5 more for a
truncated turn that stays. Every length of target that can still beat or equal the
best cost so far is tried; the same cost bounds the band of cells that are filled
(Ukkonen). Of equal costs the least audit, the initials of the edits, counts.

Longer conversations are aligned in blocks of ``BLOCK`` turns, for each role the
block may start after, and the best way to each role at its end goes on. Edits of a
block end with one of its turns, so no audit of it is the beginning of another, and
blocks in a row give the same least audit as the whole. A task therefore reads a
conversation once, in order, and holds one block of it, four digests and the edits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Costs of the edits, and of a truncated turn that stays.
RENAME, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5

#: Turns, and characters of them, that are aligned as one block.
BLOCK = 32
BLOCK_CHARS = 1 << 22

#: Alignments that a worker remembers; conversations of few turns are much alike.
REMEMBERED = 100_000

#: Conversations, and characters of their audits, in one batch of results.
BATCH = 2_000
BATCH_CHARS = 1 << 22

#: What stands last: nothing, a system, a user or an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
_AFTER = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
_ROLE = {"u": "user", "a": "assistant"}

#: Inserts that bring each ending to an allowed one.
_CLOSING = {START: "", SYSTEM: "ua", USER: "a", ASSISTANT: ""}

#: A turn that must go; else its initial, in capitals if it is truncated.
FAULTY = "-"

_BLANKS = " \t\n\x0b\x0c\r"
_LEGAL = {"su", "ua", "au"}


def _target(entry: int, system: bool, length: int) -> str:
    """The target string of a length that may follow ``entry``."""
    pair = "au" if entry == USER else "ua"
    rest = length - system
    return "s" * system + (pair * (rest // 2 + 1))[:rest]


def _fit(turn: str, char: str) -> int | None:
    """Cost of a turn standing as ``char``; None if it can't."""
    if turn == FAULTY:
        return None
    stays = TRUNCATED if turn.isupper() else 0
    if turn.lower() == char:
        return stays
    return None if char == "s" else stays + RENAME


def _aligned(turns: str, target: str, limit: int) -> tuple[int, str] | None:
    """Least cost and audit of aligning ``turns`` to ``target``, if at most ``limit``.

    Nothing is inserted behind the last turn. Only cells are filled that a path of
    cost ``limit`` can pass, by the deletes and inserts that their diagonal needs.
    """
    rows, length = len(turns), len(target)
    far = limit + 1
    shift = length - rows

    def drift(d: int) -> int:
        return INSERT * d if d > 0 else -DELETE * d

    # Columns ahead of the row number, on paths that are cheap enough.
    ahead = [d for d in range(-rows, length + 1) if drift(d) + drift(shift - d) <= limit]
    if not ahead:
        return None
    least, most = ahead[0], ahead[-1]
    table = [[far] * (length + 2) for _ in range(rows + 1)]
    table[rows][length] = 0
    for i in range(rows - 1, -1, -1):
        here, below = table[i], table[i + 1]
        turn = turns[i]
        fits = {c: _fit(turn, c) for c in "sua"}
        for j in range(min(length, i + most), max(0, i + least) - 1, -1):
            best = DELETE + below[j]
            if j < length:
                best = min(best, INSERT + here[j + 1])
                fit = fits[target[j]]
                if fit is not None:
                    best = min(best, fit + below[j + 1])
            here[j] = min(best, far)
    cost = table[0][0]
    if cost > limit:
        return None
    audit, i, j = [], 0, 0
    while i < rows:
        left = table[i][j]
        if left == DELETE + table[i + 1][j]:
            audit.append("D")
            i += 1
        elif j < length and left == INSERT + table[i][j + 1]:
            audit.append("I")
            j += 1
        else:
            audit.append("K" if turns[i].lower() == target[j] else "R")
            i, j = i + 1, j + 1
    return cost, "".join(audit)


@lru_cache(REMEMBERED)
def alignments(turns: str, entry: int) -> dict[int, tuple[int, str, bool]]:
    """For each ending: least cost, its least audit, and whether a system turn leads."""
    rows = len(turns)
    good = rows - turns.count(FAULTY)
    best: dict[int, tuple[int, str, bool]] = {}
    for system in (False, True) if entry == START and "s" in turns.lower() else (False,):
        # Deleting all and inserting the fewest is always possible, but for a system.
        bound = DELETE * rows + 2 * INSERT
        lengths = range(system, good + bound // INSERT + 1)
        for length in sorted(lengths, key=lambda m: abs(m - good)):
            target = _target(entry, system, length)
            ending = _AFTER[target[-1]] if target else entry
            limit = best[ending][0] if ending in best else bound
            kept = min(length, good)
            if DELETE * (rows - kept) + INSERT * (length - kept) > limit:
                continue
            found = _aligned(turns, target, limit)
            if found and (ending not in best or found < best[ending][:2]):
                best[ending] = (*found, system)
    return best


class _Way:
    """The best edits so far that end after a certain role."""

    def __init__(self, cost: int, parts: tuple, digest, system: bool):
        self.cost, self.parts, self.digest, self.system = cost, parts, digest, system

    def audit(self) -> str:
        parts, at = [], self.parts
        while at:
            at, part = at
            parts.append(part)
        return "".join(reversed(parts))


class Conversation:
    """Reads the turns of one conversation in order and repairs them."""

    def __init__(self):
        self.first = self.last = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.initial: str | None = None
        self.block: list[tuple[str, str, str]] = []
        self.chars = 0
        self.ways = {START: _Way(0, (), hashlib.sha256(), False)}
        # The ends of ``ways``, by rising audit.
        self.order = [START]

    def add(self, turn: int | None, role: str, text: str, seen: bool) -> None:
        """``seen``: role and text stand in an earlier turn."""
        if turn is not None:
            if self.first is None:
                self.first = turn
            self.turns += turn != self.last
            self.last = turn
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in _LEGAL:
            self.illegal += 1
        self.initial = initial
        sign = initial if initial and initial in "sua" else "x"
        ends = text.rstrip(_BLANKS)
        if not ends:
            self.blank += 1
            sign = FAULTY
        elif seen:
            self.duplicate += 1
            sign = FAULTY
        elif ends[-1] not in ".!?":
            self.truncated += 1
            sign = sign.upper()
        self.block.append((sign, role, text))
        self.chars += len(text)
        if len(self.block) >= BLOCK or self.chars > BLOCK_CHARS:
            self._close_block()

    def _close_block(self) -> None:
        if not self.block:
            return
        signs = "".join(sign for sign, _, _ in self.block)
        found: dict[int, tuple] = {}
        # Ways come by rising audit, so the first of equal cost has the least.
        for place, entry in enumerate(self.order):
            for ending, (cost, part, system) in alignments(signs, entry).items():
                total = self.ways[entry].cost + cost
                if ending not in found or total < found[ending][0]:
                    found[ending] = (total, place, part, entry, system)
        ways = {}
        for ending, (total, _, part, entry, system) in found.items():
            before = self.ways[entry]
            digest = before.digest.copy()
            self._write(digest, entry, part)
            ways[ending] = _Way(total, (before.parts, part), digest, before.system or system)
        self.order = sorted(found, key=lambda ending: found[ending][1:3])
        self.ways, self.block, self.chars = ways, [], 0

    def _write(self, digest, state: int, part: str) -> None:
        """Add the repaired turns of the block to the digest."""
        at = 0
        for edit in part:
            if edit != "I":
                _, role, text = self.block[at]
                at += 1
            if edit == "D":
                continue
            char = "a" if state == USER else "u"
            if edit == "K":
                char = role[:1]
            else:
                role = _ROLE[char]
            line = f"{role}:{'' if edit == 'I' else text}"
            digest.update((("\n" if state != START else "") + line).encode())
            state = _AFTER[char]

    def result(self) -> tuple:
        self._close_block()
        places = {ending: place for place, ending in enumerate(self.order)}
        ending = min(self.ways, key=lambda e: (self.ways[e].cost + INSERT * len(_CLOSING[e]), places[e]))
        way, closing = self.ways[ending], "I" * len(_CLOSING[ending])
        self._write(way.digest, ending, closing)
        gaps = self.last - self.first + 1 - self.turns if self.first is not None else 0
        return (
            gaps, self.blank, self.duplicate, self.truncated, self.illegal,
            way.cost + INSERT * len(closing), way.audit() + closing, way.digest.hexdigest(), way.system,
        )


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after the damage that the crc32 of ``conv_id:turn`` modulo 20 decides.

    0 drops a row, 1 empties its text, 2 removes ``.``, ``!`` and ``?``, 3 repeats it,
    4 makes it the user's. NULLs read as one space, but for an id or turn itself.
    Dropped rows stay, marked in ``dropped``, so that no conversation is lost.
    """

    def part(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20
    text = F.when(kind <= 1, "").when(kind == 2, F.translate(part("text"), ".!?", "")).otherwise(part("text"))
    return conversations.select(
        "conv_id",
        F.col("turn").cast("bigint").alias("turn"),
        F.when(kind == 4, "user").otherwise(part("role")).alias("role"),
        text.alias("text"),
        (kind == 0).alias("dropped"),
        F.explode(F.sequence(F.lit(1), F.when(kind == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


def _as_given(conversations: DataFrame) -> DataFrame:
    """The rows as they are; NULL roles and texts read as one space."""
    return conversations.select(
        "conv_id",
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        F.lit(False).alias("dropped"),
    )


def _in_order(rows: DataFrame) -> DataFrame:
    """Whole conversations in a partition each, their turns in order, marked if ``seen``.

    NULL turns come first, turns of one number by role and text. One shuffle: the
    window over equal turns needs what a conversation's partition has.
    """
    dealt = rows.repartition("conv_id")
    said = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    equal = Window.partitionBy("conv_id", "dropped", "said").orderBy("turn")
    nth = dealt.withColumn("said", said).withColumn("nth", F.row_number().over(equal)).drop("said")
    return nth.sortWithinPartitions("conv_id", "turn", "role", "text", "nth")


def audits(rows: DataFrame) -> DataFrame:
    """Faults, cost and edits of each ``conv_id`` of ``damaged`` rows or rows as given.

    ``audit`` has the initials of the edits: keep, rerole, delete, insert. The digest
    is of the repaired turns, ``role:text``, joined by line feeds; ``system_first``
    says whether a system turn leads them. A conversation without rows has zeros.
    """
    fields = (
        "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
        "audit string, repaired_sha256 string, system_first boolean"
    )
    schema = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, {fields}"
    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        chars, current, reading = 0, None, None

        def made() -> pa.RecordBatch:
            columns = [pa.array([row[i] for row in out], target[i].type) for i in range(len(target))]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, schema=target)

        for batch in batches:
            for conv_id, turn, role, text, dropped, nth in zip(*(c.to_pylist() for c in batch.columns)):
                if reading is None or conv_id != current:
                    if reading:
                        out.append((current, *reading.result()))
                        chars += len(out[-1][7])
                    if len(out) >= BATCH or chars > BATCH_CHARS:
                        yield made()
                        chars = 0
                    current, reading = conv_id, Conversation()
                if not dropped:
                    reading.add(turn, role, text, nth > 1)
        if reading:
            out.append((current, *reading.result()))
        yield made()

    ordered = _in_order(rows).select("conv_id", "turn", "role", "text", "dropped", "nth")
    return ordered.mapInArrow(run, schema)


def repair(conversations: DataFrame, damage: bool = False) -> DataFrame:
    """``audits`` of a table ``conv_id, turn, role, text``.

    One row for each ``conv_id``, NULL being one of its own. NULL turns come first
    and leave no gaps; NULL, empty and blank texts are blank turns; turns of one
    number go by role and text, equal rows are duplicates; no rows give no rows;
    other columns are not looked at, whatever their names. ``damage`` damages the
    rows first.
    """
    return audits(damaged(conversations) if damage else _as_given(conversations))


def repaired_turns(conversations: DataFrame, damage: bool = False) -> DataFrame:
    """The turns that stay: ``conv_id``, ``place`` from 1, ``role``, ``text``, ``edit``.

    NULLs, ties, repeats and empty tables are taken as by ``repair``; inserted turns
    have an empty text.
    """
    rows = damaged(conversations) if damage else _as_given(conversations)
    edits = audits(rows).select("conv_id", "system_first", F.posexplode(F.split("audit", "")).alias("at", "edit"))
    edits = edits.where("edit <> ''")
    upto = Window.partitionBy("conv_id").orderBy("at")
    edits = edits.withColumns(
        {
            "nth_row": F.when(F.col("edit") != "I", F.count_if(F.col("edit") != "I").over(upto)),
            "place": F.count_if(F.col("edit") != "D").over(upto),
        }
    ).where("edit <> 'D'")
    equal = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    numbered = rows.where(~F.col("dropped")).withColumn("row_number", F.row_number().over(equal))
    numbered = numbered.withColumnRenamed("conv_id", "row_conv_id")
    same = F.col("conv_id").eqNullSafe(F.col("row_conv_id")) & (F.col("nth_row") == F.col("row_number"))
    found = edits.join(numbered, same, "left")
    odd = (F.col("place") - F.col("system_first").cast("int")) % 2 == 1
    given = F.when(odd, "user").otherwise("assistant")
    return found.select(
        "conv_id",
        "place",
        F.when(F.col("edit") == "K", F.col("role")).otherwise(given).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        "edit",
    )
