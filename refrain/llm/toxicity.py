"""Toxicity by compression distance.

Two zstandard dictionaries are made from labelled text. Both end with the same
content, trained on ordinary windows; the toxic one has in front of it the short
byte runs that tell toxic from ordinary documents best (by a G test over
documents). So ordinary text compresses to the same length with both, and a
window holding toxic wording is shorter with the toxic one. The differences of a
document's windows are summed up in a few features, and a logistic curve fitted
on labelled documents that no dictionary has seen turns them into a score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refrain.llm.common import map_texts, remainder_is, sliced, spread_sample

#: The classifier is fitted on at most this many labelled documents of each class.
MAX_SAMPLE = {1: 2000, 0: 4000}
#: Longer documents are not used for fitting; they are scored like all others.
MAX_SAMPLE_CHARS = 20_000
GRAM = 6
WINDOW = re.compile(rb"(?s).{1,96}(?= |$)|\S{97,}")
LEVEL = 6
COMMON_BYTES = 16_384
TOXIC_BYTES = 2_048
#: What a gram needs to count as telling; longer runs of such grams are cut into
#: pieces of MAX_RUN bytes.
MIN_EVIDENCE = 30
MIN_DOCS = 3
MAX_RUN = 24
THRESHOLD = 0.7
TOXIC_WEIGHT = 0.25

_NOT_LETTERS = re.compile(r"[\W\d_]+")


def _plain(text: str | None) -> bytes:
    return f" {_NOT_LETTERS.sub(' ', (text or '').lower()).strip()} ".encode()


def _grams(data: bytes) -> np.ndarray:
    """Each run of GRAM bytes as one number."""
    codes = np.frombuffer(data, np.uint8).astype(np.int64)
    n = len(codes) - GRAM + 1
    if n <= 0:
        return np.empty(0, np.int64)
    return sum(codes[i : i + n] << (8 * i) for i in range(GRAM))


def _entropy(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-12, 1 - 1e-12)
    return -(p * np.log2(p) + (1 - p) * np.log2(1 - p))


def _telling_grams(toxic: list[bytes], ordinary: list[bytes]) -> np.ndarray:
    """Grams of toxic documents whose presence says most about the class."""
    grams, in_toxic = np.unique(
        np.concatenate([np.unique(_grams(t)) for t in toxic]), return_counts=True
    )
    all_ordinary = np.sort(np.concatenate([np.unique(_grams(t)) for t in ordinary]))
    in_ordinary = np.searchsorted(all_ordinary, grams, "right") - np.searchsorted(
        all_ordinary, grams
    )
    p, q = in_toxic / len(toxic), in_ordinary / len(ordinary)
    present = (p + q) / 2
    gain = 1 - (
        present * _entropy(p / (p + q))
        + (1 - present) * _entropy((1 - p) / np.maximum(2 - p - q, 1e-12))
    )
    # As a G statistic; MIN_EVIDENCE leaves chance little room over all grams.
    evidence = 2 * np.log(2) * (len(toxic) + len(ordinary)) * gain
    return grams[(evidence >= MIN_EVIDENCE) & (p > 4 * q) & (in_toxic >= MIN_DOCS)]


def _without_copies(texts: list[bytes]) -> list[bytes]:
    """Leaves out texts that mostly repeat earlier ones: copies prove nothing."""
    seen: set[int] = set()
    kept = []
    for text in texts:
        words = text.split()
        runs = {hash(tuple(words[i : i + 6])) for i in range(max(1, len(words) - 5))}
        if len(runs & seen) <= 0.2 * len(runs):
            kept.append(text)
        seen |= runs
    return kept


def _toxic_content(toxic: list[bytes], telling: np.ndarray) -> bytes:
    """The runs of telling grams, most frequent last, none inside another.

    Of a longer run every piece of MAX_RUN bytes counts, as runs of one phrase start
    and end differently; a piece is left out if all its grams are there already.
    """
    counts: dict[bytes, int] = {}
    for text in toxic:
        hit = np.isin(_grams(text), telling)
        edges = np.flatnonzero(np.diff(np.r_[False, hit, False]))
        runs = {text[a : b + GRAM - 1] for a, b in edges.reshape(-1, 2)}
        pieces = {r[i : i + MAX_RUN] for r in runs for i in range(max(1, len(r) - MAX_RUN + 1))}
        for run in pieces:
            counts[run] = counts.get(run, 0) + 1
    content, held = b"", set()
    usable = (r for r in counts if counts[r] >= MIN_DOCS)
    for run in sorted(usable, key=lambda r: (-counts[r], r)):
        grams = {run[i : i + GRAM] for i in range(len(run) - GRAM + 1)}
        if run in content or len(content) + len(run) > TOXIC_BYTES:
            continue
        if len(run) < MAX_RUN or not grams <= held:
            content = run + content
            held |= grams
    return content


@dataclass
class ToxicityModel:
    """Two dictionaries and the fitted curve; small, so it travels with the tasks."""

    common: bytes
    toxic: bytes
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: np.ndarray | None = None

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_compressors"}

    @cached_property
    def _compressors(self) -> list[zstandard.ZstdCompressor]:
        made = []
        for content in (self.common, self.toxic + self.common):
            entries = zstandard.ZstdCompressionDict(
                content, dict_type=zstandard.DICT_TYPE_RAWCONTENT
            )
            entries.precompute_compress(level=LEVEL)
            made.append(
                zstandard.ZstdCompressor(
                    level=LEVEL, dict_data=entries, write_content_size=False
                )
            )
        return made

    def features(self, text: str | None) -> list[float]:
        ordinary, toxic = self._compressors
        gains = sorted(
            (
                len(ordinary.compress(w)) - len(toxic.compress(w))
                for w in WINDOW.findall(_plain(text))
            ),
            reverse=True,
        )
        top, total = gains[:3], sum(g for g in gains if g > 0)
        return [
            min(max(gains[:1] + [0]), 12),
            min(max(sum(top), 0), 30),
            float(np.log1p(total)),
            total / max(1, len(gains)),
            float(np.log1p(len(gains))),
        ]

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """A score in 0 to 1 for each text; 0 if nothing could be learned."""
        if self.weights is None or not texts:
            return np.zeros(len(texts))
        values = (np.array([self.features(t) for t in texts]) - self.mean) / self.scale
        return 1 / (1 + np.exp(-np.clip(values @ self.weights[:-1] + self.weights[-1], -30, 30)))


def _fit_curve(values: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Logistic regression in which the toxic class weighs TOXIC_WEIGHT of all."""
    x = np.c_[values, np.ones(len(values))]
    share = np.where(
        toxic == 1, TOXIC_WEIGHT / toxic.mean(), (1 - TOXIC_WEIGHT) / (1 - toxic.mean())
    )
    weights, ridge = np.zeros(x.shape[1]), 1e-2 * np.eye(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (share * (p - toxic)) + ridge @ weights
        curve = (x * (share * p * (1 - p))[:, None]).T @ x + ridge
        weights -= np.linalg.solve(curve, slope)
    return weights


def fit_on_texts(toxic: list[str], ordinary: list[str]) -> ToxicityModel:
    """A model from labelled texts: every second one for the dictionaries, the
    others for the curve. Fewer than four of a class: a model that scores 0."""
    if min(len(toxic), len(ordinary)) < 4:
        return ToxicityModel(b"", b"")
    bad, good = ([_plain(t) for t in texts[::2]] for texts in (toxic, ordinary))
    bad, good = _without_copies(bad), _without_copies(good)
    windows = [w for t in good for w in WINDOW.findall(t)]
    try:
        common = zstandard.train_dictionary(COMMON_BYTES, windows, level=LEVEL).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: take it as it is
        common = b"".join(windows)[-COMMON_BYTES:]
    model = ToxicityModel(common, _toxic_content(bad, _telling_grams(bad, good)))
    rest = toxic[1::2] + ordinary[1::2]
    values = np.array([model.features(t) for t in rest])
    marks = np.r_[np.ones(len(toxic[1::2])), np.zeros(len(ordinary[1::2]))]
    model.mean, model.scale = values.mean(0), values.std(0) + 1e-9
    model.weights = _fit_curve((values - model.mean) / model.scale, marks)
    return model


def fit(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """Fit on ``docs(doc_id, text)`` with ``labels(doc_id, toxic)``.

    Takes at most MAX_SAMPLE labelled documents of each class, chosen by a hash
    so that every run takes the same. NULL labels, ids and texts are left out; an
    id with several labels counts as toxic if one of them says so.
    """
    marks = (
        labels.select("doc_id", "toxic").where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    totals = {r["toxic"]: r["n"] for r in marks.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    wanted = F.lit(False)
    for label, most in MAX_SAMPLE.items():
        wanted |= (F.col("toxic") == label) & spread_sample(
            F.col("doc_id"), most, totals.get(label, 0)
        )
    picked = F.broadcast(marks.where(wanted))  # about as many rows as MAX_SAMPLE says
    rows = (
        docs.select("doc_id", "text").where(F.length("text") <= MAX_SAMPLE_CHARS)
        .join(picked, "doc_id").select("toxic", "text", F.xxhash64("text").alias("h"))
        .collect()
    )
    texts = {
        label: [r["text"] for r in sorted(rows, key=lambda r: (r["h"], r["text"])) if r["toxic"] == label][:most]
        for label, most in MAX_SAMPLE.items()
    }
    return fit_on_texts(texts[1], texts[0])


def score_documents(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``doc_id``, ``score`` and ``predicted`` of every row of ``docs``.

    Whole texts are scored. NULL and empty texts get the score of a text without
    any toxic window; NULL ids stay NULL; repeated rows each get their own row;
    other columns of ``docs`` are ignored; an empty table gives an empty table.
    """

    scored = map_texts(docs, lambda texts: {"score": model.scores(texts)}, "score double")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_unflagged(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores below THRESHOLD.

    Works batch by batch without a join, so NULL and repeated ids need no care.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            scores = model.scores(batch.column("text").to_pylist())
            yield batch.filter(pa.array(scores < THRESHOLD))

    return docs.mapInArrow(run, docs.schema)


def held_out_split(id_column: str = "doc_id"):
    """The rows never used for learning: crc32 of the id as text, mod 3, is 1."""
    return remainder_is(F.col(id_column), 3, 1)
