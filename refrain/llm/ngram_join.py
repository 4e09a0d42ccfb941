"""Jaccard join of shingle sets with a count-vector R-tree.

A document is the set of its distinct shingles; equal sets form one class. The
shingles of a set are hashed into GROUPS groups, and the number in each group makes
the set a point. Two sets cannot share more than the sum of the smaller of each
coordinate, and a node of an R-tree over points bounds that sum for all below it.

Sets that are similar enough share several of their first shingles in any common
order (prefix filter), so sets meet under these keys only; rare shingles come
first, judged by a sample. Under each key a tree over the points is searched in
rounds. In each round a set takes the few most promising partners outside its
component from each key; those it meets under most keys are verified and the links
make components. A set is done when all partners that the bound and the number of
common keys allow have been verified or lie in its component; each round takes more
partners from the sets that are not, the last one all. So no link between components
is lost, while the many links inside a group of near copies are never written out.
Large keys are split into blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refrain.llm.common import map_texts, release, sliced, spread_sample, stored, unused_name
from refrain.llm.components import components
from refrain.llm.repeats import KEY, keyed_texts
from refrain.llm.spans import LOWER, RangeHash, Texts, Words, byte_codes, chunks, mix, window_starts
from refrain.operators.bloom import bloom_filter, probable

SHINGLE_WORDS = 5
#: Similarity in percent.
SIMILARITY = 80
#: So many that pairs that are not similar enough hardly ever pass the bound.
GROUPS = 256
#: Coordinates of a coarser point, each the sum of several; nodes bound these.
COARSE = 32
#: The largest count that is written; it stands for any larger one, too.
FULL = 255
#: Texts sampled to find frequent shingles, which come last in the order. It sets
#: only the order, not what is found.
SAMPLE_TEXTS = 4_000
#: Two sets must meet under as many keys as the smaller size asks for: one for each
#: KEY_SHARE shingles, at most MOST_KEYS. Each adds a key to every set.
KEY_SHARE = 20
MOST_KEYS = 8
#: Rows of a key searched together, and entries of a tree node.
BLOCK_ROWS = 2_000
NODE = 16
#: Blocks of at most so many rows are one leaf.
LEAF_ROWS = 48
#: Partners that a set takes from a block, and pairs of it that are verified, by round.
#: Sets that are still not done take all in the round that follows.
TAKEN = (1, 4, 16, 64)
#: Pairs that a task counts at once.
HELD_PAIRS = 100_000
#: Pairs of rows in small blocks that are compared at once.
LEAF_PAIRS = 1 << 14
#: Keys shipped together to be counted, on average, and those a task holds.
BUCKET_KEYS = 1 << 18
HELD_KEYS = 1 << 21
#: Words of the Bloom filter of texts to verify: 2 MB.
SIEVE_WORDS = 1 << 18


class Sets:
    """The distinct shingles of some texts, by text, each as a 64-bit hash."""

    def __init__(self, texts: list[bytes], words_per_shingle: int):
        joined = Texts.join(texts)
        words = Words.of(joined)
        ranges = RangeHash(RangeHash(byte_codes(LOWER[joined.data]))(words.start, words.end))
        begin, end = words.first[:-1], words.first[1:]
        starts, text = window_starts(begin, end, words_per_shingle)
        short = np.flatnonzero((end > begin) & (end - begin < words_per_shingle))
        hashes = np.r_[ranges(starts, starts + words_per_shingle), ranges(begin[short], end[short])]
        text = np.r_[text, short]
        order = np.argsort(hashes, kind="stable")
        order = order[np.argsort(text[order], kind="stable")]
        hashes, text = hashes[order], text[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
        self.hashes, self.text = hashes[new], text[new]
        self.first = np.searchsorted(self.text, np.arange(len(texts) + 1))

    def __getitem__(self, i: int) -> np.ndarray:
        return self.hashes[self.first[i] : self.first[i + 1]]

    def sizes(self) -> np.ndarray:
        return np.diff(self.first)

    def classes(self) -> np.ndarray:
        """A hash of each whole set."""
        sums = np.r_[np.uint64(0), np.cumsum(mix(self.hashes ^ np.uint64(0xA5A5A5A5)))]
        total = sums[self.first[1:]] - sums[self.first[:-1]]
        return mix(total + self.sizes().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def points(self) -> np.ndarray:
        """How many shingles fall in each group; one row per set."""
        group = (self.hashes >> np.uint64(40)).astype(np.int64) % GROUPS
        counts = np.bincount(self.text * GROUPS + group, minlength=(len(self.first) - 1) * GROUPS)
        return counts.reshape(-1, GROUPS)

    def prefixes(self, frequent: np.ndarray, similarity: int) -> tuple[np.ndarray, np.ndarray]:
        """The keys of each set, and the set of each key.

        ``frequent`` holds frequent shingles, the most frequent last. A partner of
        a set of n shingles shares at least ``similarity`` percent of n; so of the
        first shingles, all but that many and ``keys_in_common`` more, it shares
        ``keys_in_common`` at least.
        """
        late = np.zeros(len(self.hashes), np.int64)
        if len(frequent):
            by_hash = np.argsort(frequent)
            at = np.minimum(np.searchsorted(frequent[by_hash], self.hashes), len(frequent) - 1)
            hit = frequent[by_hash[at]] == self.hashes
            late[hit] = by_hash[at[hit]] + 1
        order = np.argsort(late, kind="stable")
        order = order[np.argsort(self.text[order], kind="stable")]
        sizes = self.sizes()
        keep = sizes - -(-sizes * similarity // 100) + keys_in_common(sizes)
        place = np.arange(len(order)) - self.first[self.text[order]]
        order = order[place < keep[self.text[order]]]
        return self.hashes[order], self.text[order]


def keys_in_common(sizes: np.ndarray) -> np.ndarray:
    return np.clip(sizes // KEY_SHARE, 1, MOST_KEYS)


def _keys_in_common(size: Column) -> Column:
    """The same for a column."""
    return F.greatest(F.lit(1), F.least(F.lit(MOST_KEYS), F.floor(size / KEY_SHARE)))


def needed(size_a: np.ndarray, size_b: np.ndarray, similarity: int) -> np.ndarray:
    """Shingles that sets of these sizes must share at least."""
    return -(-similarity * (size_a + size_b) // (100 + similarity))


def _coarse(points: np.ndarray) -> np.ndarray:
    return points.reshape(len(points), -1, COARSE).sum(1, dtype=np.int32)


class CountTree:
    """An R-tree over count vectors, packed by sorting on the vectors.

    Nodes and leaves are judged by coarse points first, which bound no less.
    """

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        coarse = _coarse(points)
        self.order = np.lexsort(coarse.T[::-1])
        self.points, self.coarse, self.sizes = points[self.order], coarse[self.order], sizes[self.order]
        #: From the leaves up: the largest coordinates and the range of sizes.
        self.levels = []
        top, low, high = self.coarse, self.sizes, self.sizes
        while len(top) > NODE:
            at = np.arange(0, len(top), NODE)
            top = np.maximum.reduceat(top, at)
            low, high = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
            self.levels.append((top, low, high))

    def search(
        self, point: np.ndarray, size: int, similarity: int, wanted: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray]:
        """Places of the points that may be similar enough, and their bounds.

        Of these only the ``wanted`` ones, if given, a flag for each place.
        """
        coarse, at = _coarse(point[None])[0], None
        for top, low, high in reversed(self.levels):
            at = self._below(at, len(top))
            fits = (low[at] * similarity <= 100 * size) & (high[at] * 100 >= similarity * size)
            bound = np.minimum(top[at], coarse).sum(1)
            at = at[fits & (bound >= needed(np.maximum(low[at], -(-similarity * size // 100)), size, similarity))]
        at = self._below(at, len(self.points))
        at = at[np.minimum(self.coarse[at], coarse).sum(1) >= needed(self.sizes[at], size, similarity)]
        if wanted is not None:
            at = at[wanted[self.order[at]]]
        bound = np.minimum(self.points[at], point).sum(1)
        keep = bound >= needed(self.sizes[at], size, similarity)
        return self.order[at[keep]], bound[keep]

    @staticmethod
    def _below(nodes: np.ndarray | None, n: int) -> np.ndarray:
        if nodes is None:
            return np.arange(n)
        at = (nodes[:, None] * NODE + np.arange(NODE)).ravel()
        return at[at < n]


def sets_of(docs: DataFrame, words: int, frequent: np.ndarray, similarity: int) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``class`` (NULL if empty), ``point`` and ``keys``."""
    known = docs.sparkSession.sparkContext.broadcast(frequent)  # bounded by the sample

    def run(texts: list[str | None]) -> dict:
        made = {"n_shingles": [], "class": [], "point": [], "keys": []}
        for _, chunk in chunks(texts):
            sets = Sets(chunk, words)
            sizes = sets.sizes()
            made["n_shingles"] += sizes.tolist()
            made["class"] += [
                c if n else None for c, n in zip(sets.classes().view(np.int64).tolist(), sizes)
            ]
            made["point"] += [p.tobytes() for p in np.minimum(sets.points(), FULL).astype("u1")]
            keys, text = sets.prefixes(known.value, similarity)
            cuts = np.searchsorted(text, np.arange(len(chunk) + 1))
            made["keys"] += [keys[x:y].tobytes() for x, y in zip(cuts[:-1], cuts[1:])]
        return made

    return map_texts(docs, run, "n_shingles bigint, class bigint, point binary, keys binary", KEY)


def frequent_shingles(docs: DataFrame, words: int, sample: int) -> np.ndarray:
    """Shingles in at least three of about ``sample`` texts, rarest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            for _, chunk in chunks(batch["text"].to_pylist()):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(Sets(chunk, words).hashes.view(np.int64))], names=["shingle"]
                )

    total = docs.count()
    texts = docs.select("text").where(spread_sample(F.col("text"), sample, total)).distinct()
    found = (
        texts.mapInArrow(run, "shingle bigint").groupBy("shingle").agg(F.count("*").alias("n"))
        .where("n >= 3").collect()
    )
    found.sort(key=lambda r: (r["n"], r["shingle"]))
    return np.array([r["shingle"] for r in found], np.int64).view(np.uint64)


def shared_keys(sets: DataFrame) -> DataFrame:
    """``key`` and ``class`` for keys that at least two classes have.

    Keys are dealt to buckets and travel packed, many in a row.
    """
    total = sets.agg(F.sum(F.length("keys"))).first()[0] or 0
    buckets = np.uint64(max(1, total // 8 // BUCKET_KEYS))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = batch["keys"].to_pylist()
            keys = np.frombuffer(b"".join(packed), np.uint64)
            owner = np.repeat(batch["class"].to_numpy(), [len(p) // 8 for p in packed])
            bucket = (mix(keys) % buckets).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            keys, owner, bucket = keys[order], owner[order], bucket[order]
            names, first = np.unique(bucket, return_index=True)
            cuts = list(zip(first.tolist(), [*first[1:].tolist(), len(keys)]))
            parts = [pa.array([c[x:y].tobytes() for x, y in cuts], pa.binary()) for c in (keys, owner)]
            yield pa.RecordBatch.from_arrays([pa.array(names), *parts], names=["bucket", "keys", "classes"])

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = None, _Met()
        for batch in batches:
            for at, keys, owner in zip(*(batch[c].to_pylist() for c in ("bucket", "keys", "classes"))):
                if at != bucket:
                    yield held.shared()
                    bucket, held = at, _Met()
                held.add(np.frombuffer(keys, np.int64), np.frombuffer(owner, np.int64))
                if held.size >= HELD_KEYS:
                    yield held.shared()
        yield held.shared()

    # Exact copies have the same keys; one stays.
    classes = sets.where("class IS NOT NULL").groupBy("class").agg(F.min("keys").alias("keys"))
    packed = classes.mapInArrow(pack, "bucket bigint, keys binary, classes binary")
    dealt = packed.repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(unpack, "key bigint, class bigint")


class _Met:
    """The keys of a bucket. Those met twice are passed on, so that even a key of
    very many classes is not held."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0
        self.known = np.empty(0, np.int64)

    def add(self, keys: np.ndarray, owner: np.ndarray) -> None:
        self.parts.append((keys, owner))
        self.size += len(keys)

    def shared(self) -> pa.RecordBatch:
        """Rows of keys met twice up to now; rows of other keys stay."""
        none = [np.empty(0, np.int64)]
        keys, owner = (np.concatenate([p[i] for p in self.parts] or none) for i in (0, 1))
        order = np.argsort(keys, kind="stable")
        keys, owner = keys[order], owner[order]
        same = keys[1:] == keys[:-1]
        twice = np.r_[same, False] | np.r_[False, same] if len(keys) else np.zeros(0, bool)
        if len(self.known):
            twice |= np.isin(keys, self.known)
        self.known = np.union1d(self.known, keys[twice])
        self.parts, self.size = [(keys[~twice], owner[~twice])], 0
        return pa.RecordBatch.from_arrays([pa.array(keys[twice]), pa.array(owner[twice])], names=["key", "class"])


def _candidates(rows: DataFrame, similarity: int, taken: int | None) -> DataFrame:
    """Partners ``b`` that classes ``a`` find, and under how many keys (``votes``).

    ``rows`` has ``key``, ``part`` and ``asking``, which make a block, ``class``,
    ``n_shingles``, ``point``, ``asks``, ``told``, ``label`` and ``rank_size`` and
    ``rank_label``, which say who asks whom: each row that asks finds, among those
    told with another label and no lower rank, the ``taken`` most promising (all if
    None). A row with ``a`` = ``b`` says in how many blocks there were more.
    """

    def beside(rows: dict, points: np.ndarray, coarse: np.ndarray, first: np.ndarray, count: np.ndarray):
        """Pairs of rows and their bounds in blocks that are single leaves.

        Row i is compared with the ``count[i]`` rows from ``first[i]`` on; many
        blocks go at once.
        """
        asking = np.flatnonzero(rows["asks"] & (count > 0))
        ends = np.cumsum(count[asking])
        for at in np.split(asking, np.searchsorted(ends, np.arange(LEAF_PAIRS, ends[-1], LEAF_PAIRS))) if len(ends) else ():
            a = np.repeat(at, count[at])
            b = np.arange(len(a)) + np.repeat(first[at] - np.cumsum(count[at]) + count[at], count[at])
            keep = may_find(rows, a, b)
            a, b = a[keep], b[keep]
            for each in (coarse, points):
                bound = np.minimum(each[a], each[b]).sum(1, dtype=np.int64)
                keep = bound >= needed(rows["n_shingles"][a], rows["n_shingles"][b], similarity)
                a, b, bound = a[keep], b[keep], bound[keep]
            yield a, b, bound

    def searched(rows: dict, points: np.ndarray, lo: int, hi: int):
        """The same in a larger block, row by row down its tree."""
        sizes = rows["n_shingles"]
        there = lo + np.flatnonzero(rows["told"][lo:hi])
        tree = CountTree(points[there], sizes[there])
        for i in lo + np.flatnonzero(rows["asks"][lo:hi]):
            wanted = may_find(rows, np.array([i]), there)
            at, bound = tree.search(points[i], int(sizes[i]), similarity, wanted)
            yield np.full(len(at), i), there[at], bound

    def may_find(rows: dict, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        size, label = rows["rank_size"], rows["rank_label"]
        higher = (size[b] > size[a]) | ((size[b] == size[a]) & (label[b] >= label[a]))
        return rows["told"][b] & (rows["label"][a] != rows["label"][b]) & higher

    def named(rows: dict, a: np.ndarray, b: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The most promising partners of each row, and itself if there are more."""
        ids = rows["class"]
        if taken is None or not len(a):
            return ids[a], ids[b]
        promise = bound / np.maximum(needed(rows["n_shingles"][a], rows["n_shingles"][b], similarity), 1)
        # Ties go to the smallest, so that near copies gather around few.
        order = np.lexsort((ids[b], -promise, a))
        a, b = a[order], b[order]
        place = np.arange(len(a)) - np.searchsorted(a, a)
        more = a[place == taken]
        a, b = a[place < taken], b[place < taken]
        return np.r_[ids[a], ids[more]], np.r_[ids[b], ids[more]]

    def counted(pairs: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        a, b = (np.concatenate([p[i] for p in pairs] or [np.empty(0, np.int64)]) for i in (0, 1))
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        new = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])][: len(a)])
        votes = np.diff(np.r_[new, len(a)])
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (a[new], b[new], votes)], names=["a", "b", "votes"])

    def found_in(table: pa.Table) -> Iterator[pa.RecordBatch]:
        if not table.num_rows:
            return
        block = _block_ids(table)
        cuts = np.flatnonzero(np.r_[True, block[1:] != block[:-1], True])
        names = ("class", "n_shingles", "label", "asks", "told", "rank_size", "rank_label")
        rows = {c: table[c].to_numpy() for c in names}
        data = b"".join(table["point"].to_pylist())
        points = np.frombuffer(data, "u1").reshape(-1, GROUPS).astype(np.int32)
        points[points == FULL] = 1 << 24
        length = np.diff(cuts)
        count = np.where((length > 1) & (length <= LEAF_ROWS), length, 0)
        large = np.flatnonzero(length > LEAF_ROWS)
        found = [beside(rows, points, _coarse(points), np.repeat(cuts[:-1], length), np.repeat(count, length))]
        found += [searched(rows, points, cuts[i], cuts[i + 1]) for i in large]
        pairs, held = [], 0
        for a, b, bound in chain.from_iterable(found):
            pairs.append(named(rows, a, b, bound))
            held += len(pairs[-1][0])
            if held >= HELD_PAIRS:
                yield counted(pairs)
                pairs, held = [], 0
        yield counted(pairs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            rest = pa.concat_tables([rest, table]) if rest is not None else table
            done, rest = _whole_groups(rest)
            yield from found_in(done)
        if rest is not None:
            yield from found_in(rest)

    dealt = rows.repartition("key", "part", "asking").sortWithinPartitions("key", "part", "asking", "class")
    found = dealt.mapInArrow(run, "a bigint, b bigint, votes bigint")
    return found.groupBy("a", "b").agg(F.sum("votes").alias("votes"))


def _block_ids(table: pa.Table) -> np.ndarray:
    keys = [table[c].to_numpy() for c in ("key", "part", "asking")]
    change = np.zeros(table.num_rows, bool)
    for k in keys:
        change[1:] |= k[1:] != k[:-1]
    return np.cumsum(change)


def _whole_groups(table: pa.Table) -> tuple[pa.Table, pa.Table]:
    """All but the last block, and the last, which may go on."""
    if not table.num_rows:
        return table, table
    block = _block_ids(table)
    cut = int(np.searchsorted(block, block[-1]))
    return table.slice(0, cut), table.slice(cut)


def _verified(pairs: DataFrame, texts: DataFrame, words: int, similarity: int) -> DataFrame:
    """The pairs whose sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            keep = np.zeros(batch.num_rows, bool)
            both = zip(batch["text_a"].to_pylist(), batch["text_b"].to_pylist())
            number: dict[str, int] = {}
            places = [(number.setdefault(x, len(number)), number.setdefault(y, len(number))) for x, y in both]
            sets: dict[int, np.ndarray] = {}
            for first, chunk in chunks(list(number)):
                made = Sets(chunk, words)
                sets |= {first + i: made[i] for i in range(len(chunk))}
            for row, (x, y) in enumerate(places):
                shared = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                keep[row] = 100 * shared >= similarity * (len(sets[x]) + len(sets[y]) - shared)
            yield batch.filter(pa.array(keep)).select(["a", "b"])

    one = texts.select(F.col("class").alias("a"), F.col("text").alias("text_a"))
    two = texts.select(F.col("class").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "text_a", "text_b").mapInArrow(
        run, "a bigint, b bigint"
    )


def _labels(found: DataFrame | None, classes: DataFrame) -> DataFrame:
    """``class`` and the component of each as ``label``."""
    if found is None:
        return classes.select("class", F.col("class").alias("label"))
    parts = found.select(F.col("node").alias("class"), F.col("component"))
    return classes.select("class").join(parts, "class", "left").select(
        "class", F.coalesce("component", "class").alias("label")
    )


def _chosen(
    votes: DataFrame, unseen: DataFrame, tried: DataFrame | None, enough: DataFrame, taken: int | None
) -> DataFrame:
    """Pairs ``a``, ``b`` to verify, and who must go on, as rows without ``b``.

    A pair can be a link only if it met under ``enough`` keys, those counted where
    ``a`` had more partners than it named, or did not see all rows (``unseen``).
    """
    hidden = votes.where("a = b").select("a", F.col("votes").alias("hidden")).unionAll(unseen)
    hidden = hidden.groupBy("a").agg(F.sum("hidden").alias("hidden"))
    asker = enough.join(hidden, "a", "left").withColumn("hidden", F.coalesce("hidden", F.lit(0)))
    pairs = votes.where("a <> b").join(asker, "a").where("votes + hidden >= enough")
    if tried is not None:
        pairs = pairs.join(
            tried, (F.least("a", "b") == F.col("x")) & (F.greatest("a", "b") == F.col("y")), "left_anti"
        )
    if taken is None:
        return pairs.select("a", "b")
    # The partner after the last that is taken says that there are more.
    place = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("votes"), "b"))
    pairs = pairs.withColumn("place", place).where(F.col("place") <= taken + 1)
    pairs = pairs.select("a", F.when(F.col("place") <= taken, F.col("b")).alias("b"))
    return pairs.unionAll(
        asker.where("hidden >= enough").select("a", F.lit(None).cast("long").alias("b"))
    )


def linked_classes(
    docs: DataFrame, sets: DataFrame, words: int = SHINGLE_WORDS, similarity: int = SIMILARITY,
    block_rows: int = BLOCK_ROWS, rounds: tuple[int, ...] = TAKEN,
) -> DataFrame:
    """``class`` and ``label``: classes that are linked, directly or by others.

    ``sets`` is what ``sets_of`` makes, stored; it is released when it is used up.
    Classes linked with no other are left out. ``rounds`` says how many partners a
    class takes in each round before the last, which takes all.
    """
    keys = stored(shared_keys(sets), "key-rows")
    first = F.struct("doc_id", "n_shingles", "point")
    classes = stored(
        sets.where("class IS NOT NULL").groupBy("class").agg(F.min_by(first, "doc_id").alias("s"))
        .select("class", "s.*"),
        "classes",
    )
    release(sets)
    large = stored(
        keys.groupBy("key").agg(F.count("*").alias("rows")).where(F.col("rows") > block_rows), "large-keys"
    )
    enough = classes.select(
        F.col("class").alias("a"),
        _keys_in_common(F.col("n_shingles") * similarity / 100).alias("enough"),
    )
    blocks = F.ceil(F.coalesce("rows", F.lit(1)) / block_rows).cast("int")
    same = F.lit(0).cast("long")
    # In the first round, each block of a key by itself, all rows ask all others.
    meeting = keys.join(large, "key", "left").join(classes, "class").select(
        "key", F.pmod(F.xxhash64("class"), blocks).cast("int").alias("part"),
        F.lit(0).alias("asking"), "class", "n_shingles", "point",
        F.lit(True).alias("asks"), F.lit(True).alias("told"), F.col("class").alias("label"),
        same.alias("rank_size"), same.alias("rank_label"),
    )
    votes = stored(_candidates(meeting, similarity, rounds[0]), "votes")
    split = stored(
        keys.join(large, "key").groupBy(F.col("class").alias("a"))
        .agg(F.count("*").alias("hidden")),
        "split",
    )
    # Whoever has a link has found something under enough keys, or did not see all.
    met = votes.where("a <> b").select("a", "votes").unionAll(split.select("a", F.col("hidden")))
    involved = stored(
        met.groupBy("a").agg(F.sum("votes").alias("met")).join(enough, "a").where("met >= enough")
        .select(F.col("a").alias("class")),
        "involved",
    )
    enough = stored(enough.join(involved, F.col("a") == F.col("class"), "left_semi"), "enough")
    classes_left = stored(
        classes.join(involved, "class", "left_semi").select("class", "doc_id", "n_shingles", "point"),
        "involved-classes",
    )
    release(classes)
    texts = stored(_texts_of(docs, classes_left.select("class", "doc_id")), "class-texts")
    found = tried = going = None
    live = label = None
    for taken in (*rounds, None):
        if going is not None:
            rows = stored(_asking_rows(live.join(ranked, "class"), label, going, block_rows), "asking-rows")
            release(live)
            found_rows = rows.join(classes_left.select("class", "point"), "class")
            votes = stored(_candidates(found_rows, similarity, taken), "votes")
            # Keys that are left out now stay out.
            live = stored(rows.where("told AND asking = 0").select(live.columns), "live-rows")
            release(rows)
        chosen = stored(_chosen(votes, split if going is None else split.limit(0), tried, enough, taken), "chosen")
        release(votes, *([going] if going is not None else []))
        pairs = stored(
            chosen.where("b IS NOT NULL").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            .distinct(),
            "pairs",
        )
        links = stored(_verified(pairs, texts, words, similarity), "links")
        known = pairs.select(F.col("a").alias("x"), F.col("b").alias("y"))
        known = stored(known if tried is None else known.unionAll(tried), "tried")
        if tried is not None:
            release(tried)
        tried = known
        release(pairs)
        if found is None or not links.isEmpty():
            tied = links if found is None else links.unionByName(
                found.select(F.col("node").alias("a"), F.col("component").alias("b"))
            )
            joined = stored(components(tied), "components")
            if found is not None:
                release(found, label)
            found = joined
            label = stored(_labels(found, involved), "labels")
        going = stored(chosen.where("b IS NULL").select(F.col("a").alias("class")).distinct(), "going")
        release(chosen, links)
        if going.isEmpty():
            break
        if live is None:
            # Who asks whom stays as it is now, so that a class that is done stays done.
            size = label.groupBy(F.col("label").alias("rank_label")).agg(F.count("*").alias("rank_size"))
            rank = label.withColumnRenamed("label", "rank_label").join(size, "rank_label")
            ranked = classes_left.join(rank, "class").select("class", "n_shingles", "rank_size", "rank_label")
            ranked = stored(ranked, "ranks")
            live = stored(keys.join(ranked, "class", "left_semi"), "live-rows")
            release(keys)
    release(large, classes_left, going, tried, label, split, texts, involved, enough)
    release(*([live, ranked] if live is not None else [keys]))
    return found.select(F.col("node").alias("class"), F.col("component").alias("label"))


def _asking_rows(
    live: DataFrame, label: DataFrame, going: DataFrame, block_rows: int
) -> DataFrame:
    """The rows of a later round: who asks is in one block with all that it may find.

    Under each key all classes but those of the highest rank may ask, if they are
    among ``going``. Those that ask are dealt to ``askings`` parts and those that are
    told to ``parts``; each two meet in one block. Keys under which nobody asks, or
    with a single component, are left out.
    """
    asker = going.select("class", F.lit(True).alias("goes"))
    rows = live.join(label.join(asker, "class", "left"), "class")
    by_key = rows.groupBy("key").agg(
        F.max(F.struct("rank_size", "rank_label")).alias("top"),
        F.count("*").alias("rows"),
        F.min("label").alias("low"), F.max("label").alias("high"),
        F.count("goes").alias("askers"),
    ).where("low < high AND askers > 0")
    below = F.col("goes").isNotNull() & (F.struct("rank_size", "rank_label") < F.col("top"))
    rows = rows.join(by_key.drop("low", "high"), "key").select(
        "key", "class", "n_shingles", "label", "rank_size", "rank_label",
        F.coalesce(below, F.lit(False)).alias("goes"),
        F.ceil(F.col("rows") / block_rows).cast("int").alias("parts"),
        F.ceil(F.col("askers") / block_rows).cast("int").alias("askings"),
    )
    kept = ["class", "n_shingles", "label", "rank_size", "rank_label"]
    told = rows.select(
        "key", F.pmod(F.xxhash64("class"), "parts").cast("int").alias("part"),
        F.explode(F.sequence(F.lit(0), F.col("askings") - 1)).alias("asking"), *kept,
        F.lit(False).alias("asks"), F.lit(True).alias("told"),
    )
    asking = rows.where("goes").select(
        "key", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        F.pmod(F.xxhash64("class", F.lit(1)), "askings").cast("int").alias("asking"), *kept,
        F.lit(True).alias("asks"), F.lit(False).alias("told"),
    )
    return told.unionByName(asking)


def _texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The text of each ``class`` in ``wanted``, by the ``doc_id`` of one of its rows."""
    ids = wanted.select("class", F.col("doc_id").alias("key"))
    maybe = probable(docs, "doc_id", bloom_filter(ids.select("key"), SIEVE_WORDS), SIEVE_WORDS)
    found = maybe.join(ids, F.col("doc_id") == F.col("key"))
    return found.groupBy("class").agg(F.min("text").alias("text"))


def _labelled_documents(docs: DataFrame, **options) -> DataFrame:
    """``doc_id`` (the key of ``keyed_texts``), ``n_shingles``, ``class``, ``label``."""
    texts = keyed_texts(docs)
    words, similarity = options.get("words", SHINGLE_WORDS), options.get("similarity", SIMILARITY)
    frequent = frequent_shingles(texts, words, options.pop("sample", SAMPLE_TEXTS))
    sets = stored(sets_of(texts, words, frequent, similarity), "sets")
    bare = stored(sets.drop("point", "keys"), "bare-sets")
    linked = linked_classes(texts, sets, **options)
    label = linked.select(F.col("class").alias("c"), "label")
    labelled = stored(
        bare.join(label, F.col("class") == F.col("c"), "left")
        .withColumn("label", F.coalesce("label", "class")).drop("c"),
        "labelled",
    )
    release(bare)
    return labelled


def join_documents(docs: DataFrame, **options) -> DataFrame:
    """Each row of ``docs`` (``doc_id``, ``text``) with its set and component.

    Returns ``doc_id``, ``n_shingles``, ``class`` and ``component_id``, the smallest
    ``doc_id`` reachable over links, its own included. Sets without shingles (NULL
    or empty texts, or only white space) are linked with nothing; texts of fewer
    words than a shingle are one shingle; rows with equal sets are linked, repeated
    rows too; NULL ids stay NULL and count as larger than others; other columns
    are ignored.
    """
    labelled = _labelled_documents(docs, **options)
    least = stored(
        labelled.where("label IS NOT NULL").groupBy(F.col("label").alias("l"))
        .agg(F.min("doc_id.doc_id").alias("least")),
        "least",
    )
    return labelled.join(least, F.col("label") == F.col("l"), "left").select(
        "doc_id.doc_id", "n_shingles", "class",
        F.coalesce("least", "doc_id.doc_id").alias("component_id"),
    )


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """``docs``, all columns, with one document of each component left.

    The one with the smallest id stays; NULL counts as larger. Documents without
    shingles all stay; of rows that repeat id and text one stays. Columns may have
    any names; an empty table stays empty.
    """
    labelled = _labelled_documents(docs, **options).where("label IS NOT NULL")
    order = F.struct(F.col("doc_id.doc_id").isNull(), "doc_id")
    first = stored(
        labelled.groupBy(F.col("label").alias("l")).agg(F.min_by("doc_id", order).alias("first")), "first"
    )
    dropped = (
        labelled.join(first, F.col("label") == F.col("l")).where("doc_id <> first")
        .select(F.col("doc_id").alias("key")).distinct()
    )
    dropped = stored(dropped, "dropped")
    release(first)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"))
    name = unused_name("kept_key", docs)
    keyed = docs.withColumn(name, key)
    left = keyed.join(dropped, keyed[name] == dropped["key"], "left_anti")
    return left.dropDuplicates([name]).drop(name)
