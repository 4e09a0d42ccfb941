"""Packing tokenised documents into sequences of a fixed number of tokens.

Pieces are dealt at random (by hash) into blocks of about BLOCK_PIECES. Each
block is packed best-fit in order of falling length and then improved by a local
search that moves a document to another underfull bin, or exchanges one for one,
two for one or one for two, whenever that raises the sum of squared fills, until
bins run empty. A block wastes less than one sequence more than its documents
force it to, whatever the number of blocks.
"""

from __future__ import annotations

import base64
import re
import zlib
from bisect import bisect_right, insort
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from refrain.llm.common import map_texts

CAPACITY = 2048
#: Pieces packed together; a constant, so that a task's work does not grow.
BLOCK_PIECES = 16_384
#: Pairs of bins that the local search of a block looks at, at most.
MOST_TRIES = 300_000
#: Written after every document.
END_ID = 0
CACHED_CHUNKS = 300_000

#: Fixed value: the splitting pattern of the byte-level vocabulary.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
#: Texts that are one token of their own, wherever they stand.
ADDED_TOKENS = {"<|endoftext|>": 50256}
_ADDED = re.compile("(" + "|".join(map(re.escape, ADDED_TOKENS)) + ")")
_TOUCHING_SPACES = re.compile(r"\s | \s")


class _ChunkIds(dict):
    """Ids of a chunk of text as little-endian bytes, remembered up to a bound."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self._encoding = tiktoken.Encoding(
            "pieces", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}
        )

    def __missing__(self, chunk: str) -> bytes:
        ids = self.direct(chunk)
        if len(self) >= CACHED_CHUNKS:
            self.clear()
        self[chunk] = ids
        return ids

    def direct(self, text: str) -> bytes:
        return np.array(self._encoding.encode_ordinary(text), "<u4").tobytes()


@lru_cache(maxsize=4)
def _chunk_ids(path: str) -> _ChunkIds:
    return _ChunkIds(path)


def token_bytes(text: str, path: str) -> bytes:
    """The ids of ``text`` as little-endian unsigned 32-bit numbers.

    No token reaches over an added token, nor over a single space between two
    non-space characters, so a text is encoded chunk by chunk, each chunk remembered.
    A text in which white space touches white space is encoded whole.
    """
    parts = _ADDED.split(text)
    if len(parts) > 1:
        return b"".join(
            np.array([ADDED_TOKENS[p]], "<u4").tobytes() if p in ADDED_TOKENS else token_bytes(p, path)
            for p in parts
        )
    known = _chunk_ids(path)
    if _TOUCHING_SPACES.search(text):
        return known.direct(text)
    first, *rest = text.split(" ")
    return known[first] + b"".join([known[" " + chunk] for chunk in rest])


def cut(length: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """Start and length of each piece; only the first may be shorter."""
    if length <= capacity:
        return [(0, length)]
    head = length % capacity
    starts = ([0] if head else []) + list(range(head, length, capacity))
    return [(s, e - s) for s, e in zip(starts, starts[1:] + [length])]


def token_pieces(
    docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, with_ids: bool = False
) -> DataFrame:
    """The pieces of every document: ``doc_id``, ``piece``, ``start``, ``length``,
    ``ids_crc32`` and, on request, the ``ids`` themselves as binary.

    ``tokenizer_path`` names a file of base64 tokens and ranks. A NULL or empty
    text is the end id alone; NULL ids stay NULL; repeated rows are pieces of
    their own; other columns are ignored.
    """
    end = np.array([END_ID], "<u4").tobytes()

    def run(texts: list[str | None]) -> dict:
        made = {name: [] for name in ["row", *names]}
        for row, text in enumerate(texts):
            ids = token_bytes(text or "", tokenizer_path) + end
            for number, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                part = ids[4 * start : 4 * (start + length)]
                for name, value in zip(
                    made, (row, number, start, length, zlib.crc32(part), part)
                ):
                    made[name].append(value)
        return made

    schema = "piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * with_ids
    names = [field.split()[0] for field in schema.split(", ")]
    return map_texts(docs, run, schema)


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of indices: each piece, longest first, into the fullest bin it fits."""
    bins: list[list[int]] = []
    by_room: dict[int, list[int]] = {}
    rooms = 0  # bit r is set if some bin has room r
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        size = lengths[i]
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, b = capacity, len(bins)
            bins.append([])
        bins[b].append(i)
        by_room.setdefault(room - size, []).append(b)
        rooms |= 1 << (room - size)
    return bins


def _exchange(lengths, giver, taker, room):
    """What to give and what to take back so that ``taker`` gains most, or None.

    Tries a move, then one for one, one for two and two for one. The gain is at
    most ``room``.
    """
    best = (0, (), ())
    back = [((), 0)] + [((b,), lengths[b]) for b in taker]
    back += [(p, lengths[p[0]] + lengths[p[1]]) for p in combinations(taker, 2)]
    for give in [(a,) for a in giver] + list(combinations(giver, 2)):
        size = sum(lengths[a] for a in give)
        for take, other in back:
            if len(give) + len(take) <= 3 and (len(give) == 1 or len(take) == 1):
                gain = size - other
                if best[0] < gain <= room:
                    best = (gain, give, take)
    return best if best[0] else None


def improve(
    lengths: list[int], bins: list[list[int]], capacity: int, most_tries: int = MOST_TRIES
) -> list[list[int]]:
    """Local search on the underfull bins; never returns more bins.

    In passes, each underfull bin, emptiest first, gives to fuller ones, fullest
    first, one exchange at a time; each raises the sum of squared fills, so the
    search ends. It stops when a pass changes nothing, after ``most_tries`` pairs of
    bins, or when the room left adds up to less than a bin: then no packing is
    smaller.
    """
    bins = [list(b) for b in bins]
    fill = [sum(lengths[i] for i in b) for b in bins]
    open_bins = sorted((f, b) for b, f in enumerate(fill) if f < capacity)
    spare, tries, moved = sum(capacity - f for f, _ in open_bins), 0, True
    while moved and spare >= capacity:
        moved = False
        for _, giver in list(open_bins):
            while bins[giver] and fill[giver] < capacity and spare >= capacity:
                open_bins.remove((fill[giver], giver))
                above = bisect_right(open_bins, (fill[giver], len(bins)))
                found = None
                for f, taker in reversed(open_bins[above:]):
                    tries += 1
                    if tries > most_tries:
                        return [b for b in bins if b]
                    if found := _exchange(lengths, bins[giver], bins[taker], capacity - f):
                        break
                if found:
                    gain, give, take = found
                    bins[giver] = [i for i in bins[giver] if i not in give] + list(take)
                    bins[taker] = [i for i in bins[taker] if i not in take] + list(give)
                    open_bins.remove((fill[taker], taker))
                    fill[giver], fill[taker], moved = fill[giver] - gain, fill[taker] + gain, True
                    if fill[taker] < capacity:
                        insort(open_bins, (fill[taker], taker))
                if bins[giver]:
                    insort(open_bins, (fill[giver], giver))
                else:
                    spare -= capacity
                if not found:
                    break
    return [b for b in bins if b]


def pack(lengths: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    return improve(lengths, best_fit(lengths, capacity), capacity)


def pack_pieces(
    pieces: DataFrame, total: int, capacity: int = CAPACITY, block_pieces: int = BLOCK_PIECES
) -> DataFrame:
    """``pieces`` with ``sequence_id`` and a gapless ``offset`` in the sequence.

    ``total`` is the number of pieces; it sets the number of blocks. Pieces must
    have 1 to ``capacity`` tokens. Within a sequence pieces stand in order of
    document and piece, NULL ids last. Equal rows are dealt to all blocks, so a block
    has about ``block_pieces`` whatever repeats; no pieces give no rows. ``pieces``
    must be a stored table, whose rows a lost task reads again in the same order.
    """
    blocks = max(1, -(-total // block_pieces))
    keys = [c for c in ("doc_id", "piece", "start", "ids_crc32") if c in pieces.columns]
    place = F.xxhash64(*keys, F.monotonically_increasing_id())
    dealt = pieces.withColumn("block", F.pmod(place, F.lit(blocks)))

    def run(found: pa.Table) -> pa.Table:
        found = found.sort_by([("doc_id", "ascending"), ("piece", "ascending")])
        lengths = found["length"].to_pylist()
        sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
        for number, members in enumerate(pack(lengths, capacity)):
            at = 0
            for i in sorted(members):
                sequence[i], offset[i] = number, at
                at += lengths[i]
        sequence += found["block"].to_numpy() << 32
        found = found.drop_columns(["block"])
        return found.append_column("sequence_id", pa.array(sequence)).append_column(
            "offset", pa.array(offset)
        )

    schema = StructType([*pieces.schema, *StructType.fromDDL("sequence_id bigint, offset bigint")])
    return dealt.groupBy("block").applyInArrow(run, schema)
