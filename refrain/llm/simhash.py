"""Near copies by SimHash fingerprints, found with vantage-point trees.

A fingerprint has 64 bits; bit i is set if it is set in more than half of the
hashes of a document's 3-word shingles, repeats included. Two fingerprints are
linked if at most ``RADIUS`` bits differ. A vantage-point tree splits fingerprints
by their Hamming distance to a chosen one, at the median; by the triangle
inequality only fingerprints within ``RADIUS`` of the boundary can have links across
it. The upper part of the tree, fitted on a bounded sample, deals all fingerprints
to shards, with copies of those near a boundary as mere queries; the lower part is
built and searched within each shard.

What leaves a shard is a forest of its links, not the pairs: a group of near copies
is tied together at each vantage point, and a branch whose fingerprints are all tied
to a query already is not searched for it. So a hot group costs rows in proportion.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refrain.llm.common import map_batches, release, spread_sample, stored
from refrain.llm.components import components

#: Words of a shingle, seed of its hash, and bits in which linked fingerprints differ.
SHINGLE_WORDS = 3
SEED = 42
RADIUS = 3

#: Fingerprints a shard aims at, and the most shards that the upper tree makes. Beyond
#: that shards grow and are searched in parts of at most ``PART`` fingerprints.
SHARD = 8_192
MOST_SHARDS = 2_048
PART = 65_536

#: Sampled fingerprints for each shard to fit the upper tree on: 512 KB at most.
SAMPLE = 32

#: Fingerprints of a branch that are compared one by one, and comparisons at once.
LEAF = 64
CELLS = 1 << 20

#: Shingle hashes whose bits are counted at once.
HASHES = 1 << 15


def fingerprint(text: bytes | None) -> int:
    """The fingerprint of a UTF-8 text, 0 for one without words."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < SHINGLE_WORDS:
        return xxhash.xxh64_intdigest(joined, SEED)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths) - 1
    starts = (ends - lengths + 1)[: len(words) - SHINGLE_WORDS + 1].tolist()
    ends = ends[SHINGLE_WORDS - 1 :].tolist()
    del words
    total = np.zeros(64, np.int64)
    for at in range(0, len(starts), HASHES):
        spans = zip(starts[at : at + HASHES], ends[at : at + HASHES])
        hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans], ">u8")
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > len(starts)).tobytes(), "big")


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the fingerprint ``fp`` of every row, as a signed number."""

    def run(batch: pa.RecordBatch) -> dict:
        found = [fingerprint(text.as_py()) for text in batch["text"]]
        return {"fp": pa.array(np.array(found, np.uint64).view(np.int64))}

    pair = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return map_batches(pair, run, "fp bigint", "bigint")


def _apart(points: np.ndarray, point: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ point).astype(np.int64)


def _cut(distances: np.ndarray) -> int:
    """The radius that splits at the median and leaves neither side empty."""
    return int(min(np.median(distances), distances.max() - 1))


def upper_tree(sample: np.ndarray, shards: int) -> list[tuple]:
    """Nodes ``(point, cut, inner, outer)`` of a tree; a child ``-1 - s`` is shard ``s``.

    The vantage point of a node is the one whose distances to the sample spread most.
    """
    nodes: list[tuple] = []
    leaves = 0

    def grow(points: np.ndarray, wanted: int) -> int:
        nonlocal leaves
        if wanted < 2 or len(points) < 2:
            leaves += 1
            return -leaves
        asked = points[:: max(1, len(points) // 16)][:16]
        spread = [_apart(points, p).std() for p in asked]
        point = asked[int(np.argmax(spread))]
        far = _apart(points, point)
        cut = _cut(far)
        at = len(nodes)
        nodes.append(())
        inner = grow(points[far <= cut], wanted // 2)
        nodes[at] = (point, cut, inner, grow(points[far > cut], wanted - wanted // 2))
        return at

    grow(np.unique(sample), shards)
    return nodes


def dealt(points: np.ndarray, nodes: list[tuple], radius: int = RADIUS) -> tuple[np.ndarray, ...]:
    """``row``, ``shard`` and ``home`` of each copy of a point.

    Every point has one home shard. A point outside a boundary is also a query inside
    it, and a query goes to both sides, if it is within ``radius``; so of two linked
    points in different shards one is a query in the home of the other.
    """
    rows, shards, homes = [], [], []
    open_ = [(0 if nodes else -1, np.arange(len(points)), np.ones(len(points), bool))]
    while open_:
        at, row, home = open_.pop()
        if not len(row):
            continue
        if at < 0:
            rows.append(row)
            shards.append(np.full(len(row), -1 - at, np.int32))
            homes.append(home)
            continue
        point, cut, inner, outer = nodes[at]
        far = _apart(points[row], point)
        near = far <= cut + radius
        open_.append((inner, row[near], home[near] & (far[near] <= cut)))
        beyond = far > np.where(home, cut, cut - radius)
        open_.append((outer, row[beyond], home[beyond]))
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, bool)
    return np.concatenate(rows), np.concatenate(shards), np.concatenate(homes)


class _Ties:
    """Which points are tied together so far; ``label`` is the smallest of each tie."""

    def __init__(self, size: int):
        self.label = np.arange(size)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        a, b = np.broadcast_arrays(a, b)
        while True:
            top_a, top_b = self.label[a], self.label[b]
            loose = top_a != top_b
            if not loose.any():
                return
            a, b, top_a, top_b = a[loose], b[loose], top_a[loose], top_b[loose]
            np.minimum.at(self.label, np.maximum(top_a, top_b), np.minimum(top_a, top_b))
            while (up := self.label[self.label]) is not None and (up != self.label).any():
                self.label = up


def forest(points: np.ndarray, home: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For each point the smallest one it is tied to by links of home points.

    Exact for ties: two points get the same label if and only if a chain of links,
    each with at least one home point, connects them.
    """
    ties = _Ties(len(points))
    open_ = [(np.flatnonzero(home), np.arange(len(points)))]
    while open_:
        held, asking = open_.pop()
        if not len(held) or not len(asking):
            continue
        labels = ties.label[held]
        if (labels == labels[0]).all() and len(held) > 1:
            asking = asking[ties.label[asking] != labels[0]]
            if not len(asking):
                continue
        if len(held) <= LEAF:
            step = CELLS // len(held)
            for at in range(0, len(asking), step):
                some = asking[at : at + step]
                apart = np.bitwise_count(points[held][:, None] ^ points[some][None, :])
                i, j = np.nonzero(apart <= radius)
                ties.add(held[i], some[j])
            continue
        vantage = held[len(held) // 2]
        far, far_asking = _apart(points[held], points[vantage]), _apart(points[asking], points[vantage])
        ties.add(held[far <= radius], vantage)
        ties.add(asking[far_asking <= radius], vantage)
        cut = _cut(far)
        open_.append((held[far <= cut], asking[far_asking <= cut + radius]))
        open_.append((held[far > cut], asking[far_asking > cut - radius]))
    return ties.label


def links(classes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges ``a``, ``b`` that connect what links of the distinct ``fp`` connect.

    At most one edge for each fingerprint and shard that it is dealt to.
    """
    total = classes.count()
    shards = min(MOST_SHARDS, -(-total // SHARD))
    nodes: list[tuple] = []
    if shards > 1:
        sample = classes.where(spread_sample(F.col("fp"), shards * SAMPLE, total)).select("fp").toArrow()
        nodes = upper_tree(sample["fp"].to_numpy().view(np.uint64), shards)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch["fp"].to_numpy()
            row, shard, home = dealt(fp.view(np.uint64), nodes, radius)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (fp[row], shard, home)], names=["fp", "shard", "home"]
            )

    copies = stored(classes.select("fp").mapInArrow(deal, "fp bigint, shard int, home boolean"), "dealt")
    sizes = copies.where("home").groupBy("shard").count()
    # At most MOST_SHARDS rows.
    parts = {s: -(-n // PART) for s, n in sizes.where(F.col("count") > PART).collect()}
    if parts:
        asked = F.create_map(*[F.lit(x) for pair in parts.items() for x in pair])
        count = F.coalesce(asked[F.col("shard")], F.lit(1))
        own = F.pmod(F.xxhash64("fp"), count).cast("int")
        spread = copies.withColumns({"own": own, "part": F.explode(F.sequence(F.lit(0), count - 1))})
        copies = spread.select("fp", "shard", "part", (F.col("home") & (F.col("own") == F.col("part"))).alias("home"))
    else:
        copies = copies.withColumn("part", F.lit(0))

    def search(group: pa.Table) -> pa.Table:
        fp = group["fp"].to_numpy()
        label = forest(fp.view(np.uint64), group["home"].to_numpy(), radius)
        tied = np.flatnonzero(label != np.arange(len(fp)))
        return pa.table({"a": fp[tied], "b": fp[label[tied]]})

    found = copies.groupBy("shard", "part").applyInArrow(search, "a bigint, b bigint")
    return found


def near_copies(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` of every row.

    ``component_id`` is the smallest id among the documents that links reach. NULL,
    empty and blank texts have fingerprint 0 and are linked like any other; rows
    that repeat an id stay, a NULL id is kept and is nobody's smallest unless all are
    NULL; whole texts count, whatever their length; no rows give no rows. Other
    columns are not looked at.
    """
    prints = stored(fingerprints(docs), "fingerprints")
    classes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    edges = stored(links(classes, radius), "near_links")
    tops = components(edges).select(F.col("node").alias("fp"), "component")
    tied = classes.join(tops, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    tied = stored(tied, "tied")
    heads = tied.groupBy("component").agg(F.min("least").alias("component_id"))
    named = stored(tied.join(heads, "component").select("fp", "component_id"), "named")
    release(edges, tied, classes)
    text = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return prints.join(named, "fp").select("doc_id", text, "component_id")
