"""Words that are one edit apart, found with k-d trees over letter counts.

One replaced letter changes the vector of letter counts by at most 2 in sum, one
letter more or less by 1. For each pair of equal or neighbouring lengths, the words
of one length are kept in k-d trees over these vectors and the words of the other
are range searches with that radius: a branch is left out if its box is farther
away, and words that come close enough are compared letter by letter.

The upper part of a length's tree, fitted on a bounded sample, deals words to
shards, each word to its home and as a query to the shards its range touches; the
lower part is built within a shard. What leaves a shard is one row for each word
with its number of near words and the best of them, never the pairs.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refrain.llm.common import release, spread_sample, stored

#: Least length of a word and least number of its occurrences.
MIN_LETTERS = 6
MIN_OCCURRENCES = 5

#: How many times as frequent as a word its form must be.
FORM_RATIO = 5

#: Words a shard aims at, the most shards that all upper trees make together, and the
#: words of a shard that are searched as one.
SHARD = 4_096
MOST_SHARDS = 2_048
PART = 32_768

#: Sampled words for each shard to fit the upper trees on.
SAMPLE = 32

#: Words of a branch that are compared one by one, and comparisons at once.
LEAF = 64
CELLS = 1 << 20

#: Distinct words that a task counts before it hands them on.
HELD = 200_000

#: Letters are counted in groups, which can only bring vectors nearer: a to z one by
#: one, the letters beyond ASCII by their remainder.
GROUPS = 32
_GROUP = np.array([c - 97 if 97 <= c < 123 else 26 + c % 6 for c in range(256)])

_RUN = re.compile(f"[a-zÀ-ÿ]{{{MIN_LETTERS},}}")


def damaged_words(doc_id: int | None, text: bytes | None, every: int) -> Counter:
    """Words of a UTF-8 text with their occurrences.

    Runs of letters, A to Z lower-cased; where ``every`` divides the crc32 of
    ``<doc_id>:<run>`` the letter at that crc32 modulo the length is left out. An
    ``every`` of 0 leaves all as they are. A NULL id reads as empty text.
    """
    found = Counter(_RUN.findall((text or b"").lower().decode()))
    if not every:
        return found
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    hit = [(run, h) for run in found if not (h := zlib.crc32(run.encode(), start)) % every]
    for run, h in hit:
        times, at = found[run], h % len(run)
        found[run] = 0
        hit_word = run[:at] + run[at + 1 :]
        if len(hit_word) >= MIN_LETTERS:
            # Another run may be this word itself, damaged or not.
            found["\n" + hit_word] += times
    return found


def word_counts(docs: DataFrame, every: int = 0) -> DataFrame:
    """``word`` and its occurrences ``n`` over all rows, from ``MIN_OCCURRENCES`` on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def rows() -> pa.RecordBatch:
            some = [(w, n) for w, n in counts.items() if n]
            counts.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([w for w, _ in some], pa.string()), pa.array([n for _, n in some], pa.int64())],
                names=["word", "n"],
            )

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                for word, n in damaged_words(doc_id.as_py(), text.as_py(), every).items():
                    counts[word.lstrip("\n")] += n
                if len(counts) > HELD:
                    yield rows()
        yield rows()

    pair = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    parts = pair.mapInArrow(run, "word string, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_OCCURRENCES)


def letters(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a row each. All are below 256."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def vectors(points: np.ndarray) -> np.ndarray:
    """Letter counts, a row of ``GROUPS`` for each word."""
    flat = _GROUP[points] + GROUPS * np.arange(len(points))[:, None]
    return np.bincount(flat.ravel(), minlength=GROUPS * len(points)).reshape(-1, GROUPS).astype(np.int32)


def _split(x: np.ndarray) -> tuple[int, int] | None:
    """The dimension that spreads most and its cut; both sides have points."""
    axis = int(np.argmax(x.std(0)))
    most = int(x[:, axis].max())
    if most == x[:, axis].min():
        return None
    return axis, int(min(np.median(x[:, axis]), most - 1))


def upper_tree(sample: np.ndarray, shards: int) -> list[tuple]:
    """Nodes ``(axis, cut, low, high)``; a child ``-1 - s`` stands for shard ``s``."""
    nodes: list[tuple] = []
    leaves = 0

    def grow(x: np.ndarray, wanted: int) -> int:
        nonlocal leaves
        split = _split(x) if wanted > 1 and len(x) > 1 else None
        if not split:
            leaves += 1
            return -leaves
        axis, cut = split
        at = len(nodes)
        nodes.append(())
        low = grow(x[x[:, axis] <= cut], wanted // 2)
        nodes[at] = (axis, cut, low, grow(x[x[:, axis] > cut], wanted - wanted // 2))
        return at

    grow(sample, shards)
    return nodes


def touched(x: np.ndarray, nodes: list[tuple], radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``row``, ``shard`` and L1 distance of all cells within ``radius`` of each row."""
    rows, shards, distances = [], [], []
    low, high = np.zeros(GROUPS, np.int64), np.full(GROUPS, np.iinfo(np.int64).max)
    open_ = [(0 if nodes else -1, np.arange(len(x)), np.zeros(len(x), np.int64), low, high)]
    while open_:
        at, row, far, low, high = open_.pop()
        if not len(row):
            continue
        if at < 0:
            rows.append(row)
            shards.append(np.full(len(row), -1 - at, np.int32))
            distances.append(far)
            continue
        axis, cut, below, above = nodes[at]
        value = x[row, axis]
        outside = np.maximum(np.maximum(low[axis] - value, value - high[axis]), 0)
        for child, lows, highs in ((below, low[axis], cut), (above, cut + 1, high[axis])):
            now = far - outside + np.maximum(np.maximum(lows - value, value - highs), 0)
            near = now <= radius
            cell_low, cell_high = low.copy(), high.copy()
            cell_low[axis], cell_high[axis] = lows, highs
            open_.append((child, row[near], now[near], cell_low, cell_high))
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int64)
    return np.concatenate(rows), np.concatenate(shards), np.concatenate(distances)


def _marks(x: np.ndarray) -> np.ndarray:
    """64 bits for each vector, whose differing bits are at most the L1 distance."""
    bits = np.zeros(len(x), np.uint64)
    for g in range(GROUPS):
        for least in (1, 2):
            bits |= (x[:, g] >= least).astype(np.uint64) << np.uint64(2 * g + least - 1)
    return bits


def close_pairs(
    held: np.ndarray, asking: np.ndarray, radius: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of ``held`` and ``asking`` vectors that may be within ``radius`` of each other.

    A k-d tree of the held vectors, searched for all others at once.
    """
    marks, asked = _marks(held), _marks(asking)
    open_ = [(np.arange(len(held)), np.arange(len(asking)))]
    while open_:
        mine, others = open_.pop()
        box = held[mine]
        low, high = box.min(0), box.max(0)
        for at in range(0, len(others), CELLS // GROUPS):
            some = others[at : at + CELLS // GROUPS]
            x = asking[some]
            far = (np.maximum(low - x, 0) + np.maximum(x - high, 0)).sum(1)
            near = some[far <= radius]
            split = _split(box) if len(mine) > LEAF else None
            if not len(near):
                continue
            if split:
                axis, cut = split
                below = box[:, axis] <= cut
                open_ += [(mine[below], near), (mine[~below], near)]
                continue
            step = max(1, CELLS // len(mine))
            for start in range(0, len(near), step):
                few = near[start : start + step]
                i, j = np.nonzero(np.bitwise_count(marks[mine][:, None] ^ asked[few][None, :]) <= radius)
                if len(i):
                    yield mine[i], few[j]


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows of letters differ by one edit; ``b`` is as long as ``a`` or longer by 1."""
    length = a.shape[1]
    if b.shape[1] == length:
        return (a != b).sum(1) == 1
    head = np.logical_and.accumulate(a == b[:, :length], axis=1).sum(1)
    tail = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(1)
    return head + tail >= length


class _Near:
    """Number of near words and the best of them, for each word of a group."""

    def __init__(self, words: list[str], n: list[int]):
        # The best is the most frequent, then the first by code points.
        self.order = sorted(range(len(words)), key=lambda i: (-n[i], words[i]))
        self.rank = np.empty(len(words), np.int64)
        self.rank[self.order] = np.arange(len(words))
        self.count = np.zeros(len(words), np.int64)
        self.best = np.full(len(words), len(words), np.int64)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        for one, other in ((a, b), (b, a)):
            np.add.at(self.count, one, 1)
            np.minimum.at(self.best, one, self.rank[other])


def near_within(words: list[str], n: list[int], home: np.ndarray) -> _Near:
    """Near words among those of one shard: home words of one length with each other
    and with the others, which are as long or longer by one letter."""
    found = _Near(words, n)
    mine = np.flatnonzero(home)
    sizes = np.array([len(w) for w in words])
    if not len(mine):
        return found
    length = sizes[mine[0]]
    held = letters([words[i] for i in mine])
    held_vectors = vectors(held)
    place = np.full(len(words), -1)
    place[mine] = np.arange(len(mine))
    for size, radius in ((length, 2), (length + 1, 1)):
        asking = np.flatnonzero(sizes == size)
        if not len(asking):
            continue
        theirs = letters([words[i] for i in asking])
        for i, j in close_pairs(held_vectors, vectors(theirs), radius):
            # A pair of home words comes twice, a word also meets itself.
            once = (place[asking[j]] < 0) | (place[asking[j]] > i)
            i, j = i[once], j[once]
            step = max(1, CELLS // size)
            for at in range(0, len(i), step):
                a, b = i[at : at + step], j[at : at + step]
                same = one_edit(held[a], theirs[b])
                found.add(mine[a[same]], asking[b[same]])
    return found


def _trees(words: DataFrame) -> dict[int, list[tuple]]:
    """An upper tree for each length of more than ``SHARD`` words."""
    counts = words.groupBy(F.length("word").alias("size")).count().where(F.col("count") > SHARD)
    # Each length here has more than SHARD words, and MOST_SHARDS bounds the rows.
    large = {r["size"]: r["count"] for r in counts.orderBy(F.desc("count"), "size").limit(MOST_SHARDS).collect()}
    if not large:
        return {}
    total = sum(large.values())
    aim = max(SHARD, -(-total // MOST_SHARDS))
    some = words.where(F.length("word").isin(list(large)))
    sample = some.where(spread_sample(F.col("word"), SAMPLE * -(-total // aim), total)).select("word").toArrow()
    by_size: dict[int, list[str]] = {size: [] for size in large}
    for word in sample["word"].to_pylist():
        by_size[len(word)].append(word)
    return {
        size: upper_tree(vectors(letters(found)), -(-large[size] // aim)) if found else []
        for size, found in by_size.items()
    }


def near_words(words: DataFrame) -> DataFrame:
    """``word``, ``n_near`` and the best near word with its ``n``, for words that have any."""
    trees = _trees(words)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch["word"].to_pylist()
            sizes = np.array([len(w) for w in names])
            for size in sorted(set(sizes.tolist())):
                here = np.flatnonzero(sizes == size)
                x = vectors(letters([names[i] for i in here]))
                row, shard, far = touched(x, trees.get(size, []), 2)
                home = far == 0
                own = np.empty(len(here), np.int32)
                own[row[home]] = shard[home]
                # Of two homes the later word asks in the earlier shard.
                keep = shard <= own[row]
                out = [(size, row[keep], shard[keep], home[keep])]
                if size > MIN_LETTERS:
                    row, shard, _ = touched(x, trees.get(size - 1, []), 1)
                    out.append((size - 1, row, shard, np.zeros(len(row), bool)))
                for length, row, shard, home in out:
                    taken = batch.take(pa.array(here[row]))
                    yield pa.RecordBatch.from_arrays(
                        [taken["word"], taken["n"], pa.array(np.full(len(row), length, np.int32)),
                         pa.array(shard), pa.array(home)],
                        names=["word", "n", "length", "shard", "home"],
                    )

    schema = "word string, n bigint, length int, shard int, home boolean"
    copies = stored(words.select("word", "n").mapInArrow(deal, schema), "dealt_words")
    sizes = copies.where("home").groupBy("length", "shard").count()
    large = stored(sizes.where(F.col("count") > PART), "large_shards")
    if large.isEmpty():
        copies = copies.withColumn("part", F.lit(0))
    else:
        # Words of a large shard live in one part each and ask in the others.
        parts = large.select("length", "shard", F.ceil(F.col("count") / PART).cast("int").alias("parts"))
        copies = copies.join(parts, ["length", "shard"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
        copies = copies.withColumns(
            {
                "own": F.pmod(F.xxhash64("word"), "parts").cast("int"),
                "part": F.explode(F.sequence(F.lit(0), F.col("parts") - 1)),
            }
        )
        # Of two home words in different parts the later one asks in the earlier part.
        copies = copies.where(~F.col("home") | (F.col("part") <= F.col("own")))
        copies = copies.withColumn("home", F.col("home") & (F.col("part") == F.col("own")))

    def search(group: pa.Table) -> pa.Table:
        words, n = group["word"].to_pylist(), group["n"].to_pylist()
        found = near_within(words, n, group["home"].to_numpy())
        some = np.flatnonzero(found.count).tolist()
        best = [found.order[found.best[i]] for i in some]
        return pa.table(
            {
                "word": pa.array([words[i] for i in some], pa.string()),
                "n_near": pa.array(found.count[some], pa.int64()),
                "best": pa.array([words[i] for i in best], pa.string()),
                "best_n": pa.array([n[i] for i in best], pa.int64()),
            }
        )

    grouped = copies.groupBy("length", "shard", "part")
    parts = grouped.applyInArrow(search, "word string, n_near bigint, best string, best_n bigint")
    first = F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("first")
    return parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), first).select(
        "word", "n_near", F.col("first.best").alias("best"), (-F.col("first.less")).alias("best_n")
    )


def _roots(forms: DataFrame) -> DataFrame:
    """The last of the chain of forms from each ``word``; counts rise by ``FORM_RATIO``
    with each form, so chains are short and have no circles."""
    found = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = found.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = found.join(ahead, "root", "left")
        longer = stored(moved.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        release(found)
        if longer.where("moved").isEmpty():
            return longer.drop("moved")
        found = longer.drop("moved")
        found.scratch_table = longer.scratch_table


def variants(docs: DataFrame, every: int = 0) -> DataFrame:
    """Each frequent word with its ``form``, ``root`` and number of near words.

    One row for each ``word`` of at least 6 letters and 5 occurrences over all rows:
    ``form`` is its most frequent near word, ties to the first by code points, if
    that is at least 5 times as frequent, ``root`` the end of the chain of forms.
    ``every`` damages runs as in ``damaged_words``. NULL, empty and blank texts have
    no words, repeated rows and ids count each, whole texts are read whatever their
    length, no words give no rows. Columns other than ``doc_id`` and ``text`` are not
    looked at.
    """
    words = stored(word_counts(docs, every), "words")
    near = stored(near_words(words), "near_words")
    frequent = F.col("best_n") >= FORM_RATIO * F.col("n")
    made = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(frequent, F.col("best")).alias("form"), F.when(frequent, F.col("best_n")).alias("form_n"),
    )
    made = stored(made, "variants")
    release(words, near)
    roots = _roots(made.where(F.col("form").isNotNull()))
    return made.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
