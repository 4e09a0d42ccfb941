"""Benchmark decontamination by size-partitioned MinHash containment search.

Test items are short and documents long, so a document's own MinHash says little
about an item inside it. Items are therefore partitioned by their number of
shingles, and each partition keeps, for each item, a bottom-k MinHash sketch. An
item of n shingles of which a share t lies in a document misses at most
(1 - t) * n of them, so of its floor((1 - t) * n) + 1 smallest hashes at least one
is in the document: k is set from the partition's largest size, and no match can
be missed. Documents probe the sketches with the hashes of all their shingles;
whatever they hit is verified by exact containment of the shingles themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refrain.llm.common import map_texts, sliced
from refrain.llm.spans import LOWER, RangeHash, Texts, Words, byte_codes, chunks, window_starts

SHINGLE_WORDS = 5
THRESHOLD = 0.8
#: Items are searched in blocks of at most this many bytes of text, which travel
#: with the tasks; each block is one pass over the documents.
BLOCK_BYTES = 4 << 20

#: Words are runs of ASCII letters and digits, in lower case, and other bytes.
_IS_GAP = np.ones(256, bool)
_IS_GAP[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def _hashed(texts: Texts) -> tuple[Words, np.ndarray, np.ndarray]:
    """Words, and the hash and text of every shingle."""
    words = Words.of(texts, _IS_GAP)
    of_word = RangeHash(byte_codes(LOWER[texts.data]))(words.start, words.end)
    starts, text = window_starts(words.first[:-1], words.first[1:], SHINGLE_WORDS)
    return words, RangeHash(of_word)(starts, starts + SHINGLE_WORDS), text


def _shingles(texts: Texts, words: Words, i: int) -> set[tuple[bytes, ...]]:
    """The shingles of text i themselves."""
    lower = LOWER[texts.data]
    a, b = words.first[i], words.first[i + 1]
    found = [lower[s:e].tobytes() for s, e in zip(words.start[a:b], words.end[a:b])]
    return {tuple(found[j : j + SHINGLE_WORDS]) for j in range(len(found) - SHINGLE_WORDS + 1)}


class ItemIndex:
    """Bottom-k sketches of a block of test items, partitioned by size."""

    def __init__(self, item_ids: list, texts: list[bytes], threshold: float):
        joined = Texts.join(texts)
        words, hashes, text = _hashed(joined)
        self.threshold, self.item_ids = threshold, item_ids
        self.shingles = [_shingles(joined, words, i) for i in range(len(texts))]
        self.sketch_size: dict[int, int] = {}  # of a partition, by its largest size
        keys, owners = [], []
        for i, shingles in enumerate(self.shingles):
            if shingles:
                largest = 1 << (len(shingles) - 1).bit_length()
                k = self.sketch_size.setdefault(largest, int((1 - threshold) * largest + 1e-9) + 1)
                sketch = np.unique(hashes[text == i])[:k]
                keys.append(sketch)
                owners.append(np.full(len(sketch), i))
        keys = np.concatenate(keys or [np.empty(0, np.uint64)])
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.owners = np.concatenate(owners or [np.empty(0, np.int64)])[order]

    def search(self, texts: list[bytes]) -> Iterator[tuple[int, int, int, int]]:
        """Text, item, shared shingles and shingles of the item, for each match."""
        joined = Texts.join(texts)
        words, hashes, text = _hashed(joined)
        low = np.searchsorted(self.keys, hashes)
        high = np.searchsorted(self.keys, hashes, "right")
        hits = np.flatnonzero(high > low)
        pairs = {(int(text[h]), int(o)) for h in hits for o in self.owners[low[h] : high[h]]}
        known = (-1, set())
        for i, o in sorted(pairs):
            if known[0] != i:
                known = (i, _shingles(joined, words, i))
            shared, size = len(self.shingles[o] & known[1]), len(self.shingles[o])
            if shared >= self.threshold * size - 1e-9:
                yield i, o, shared, size


def _blocks(items: DataFrame) -> Iterator[tuple[list, list[bytes]]]:
    """Items in order of size, in blocks of about BLOCK_BYTES."""
    ids, texts, size = [], [], 0
    for row in items.where("text IS NOT NULL").orderBy(F.length("text"), "item_id").toLocalIterator():
        data = row["text"].encode("utf-8", "surrogatepass")
        if texts and size + len(data) > BLOCK_BYTES:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(row["item_id"])
        texts.append(data)
        size += len(data)
    if texts:
        yield ids, texts


def contained_items(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Every pair of a document and a test item that it contains.

    ``docs`` has ``doc_id``, ``text``; ``items`` has ``item_id``, ``text``. Returns
    ``doc_id``, ``item_id``, ``n_shared``, ``n_shingles`` (distinct shingles of the
    item) and ``containment``, for containment >= ``threshold``. All rows of
    ``docs`` are searched, whole. Items below SHINGLE_WORDS words and NULL or empty
    texts match nothing; repeated rows match each for itself; NULL ids stay NULL;
    other columns are ignored; without items the result is empty.
    """

    def pass_over(index: ItemIndex) -> DataFrame:
        def run(texts: list[str | None]) -> dict:
            found = [
                (first + i, index.item_ids[o], shared, size)
                for first, chunk in chunks(texts)
                for i, o, shared, size in index.search(chunk)
            ]
            return {name: [f[k] for f in found] for k, name in enumerate(names)}

        return map_texts(docs, run, schema)

    schema = "item_id bigint, n_shared bigint, n_shingles bigint"
    names = ["row", "item_id", "n_shared", "n_shingles"]
    items = items.select(F.col("item_id").cast("long"), "text")
    passes = [pass_over(ItemIndex(i, t, threshold)) for i, t in _blocks(items)]
    passes = passes or [pass_over(ItemIndex([], [], threshold))]
    return reduce(DataFrame.unionAll, passes).withColumn(
        "containment", F.col("n_shared") / F.col("n_shingles")
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, that contain no test item.

    One pass for each block of items, without a join.
    """

    def without(frame: DataFrame, index: ItemIndex) -> DataFrame:
        def run(batches):
            for batch in sliced(batches):
                keep = np.ones(batch.num_rows, bool)
                for first, chunk in chunks(batch.column("text").to_pylist()):
                    for i, *_ in index.search(chunk):
                        keep[first + i] = False
                yield batch.filter(pa.array(keep))

        return frame.mapInArrow(run, frame.schema)

    items = items.select("item_id", "text")
    indexes = (ItemIndex(i, t, threshold) for i, t in _blocks(items))
    return reduce(without, indexes, docs)
