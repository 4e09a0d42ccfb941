"""Language identification by compression.

For each language a raw-content zstandard dictionary is cut from sampled texts.
A text is compressed, window by window, with every dictionary; the language with
the smallest sum wins. A narrow margin to the second smallest is marked as
rejected.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refrain.llm.common import map_texts, remainder_is, spread_sample

#: Documents sampled for each language, and their longest text.
SAMPLE_DOCS = 200
MAX_SAMPLE_CHARS = 20_000
#: Bytes of a dictionary, bytes of a window, and the margin below which an
#: answer is marked as rejected.
DICTIONARY_BYTES = 98_304
WINDOW = 2_048
MIN_MARGIN = 0.01
UNKNOWN = "und"

#: Matches from four bytes on, so that syllables count, not just whole words.
_PARAMETERS = {
    "strategy": zstandard.STRATEGY_GREEDY,
    "min_match": 4,
    "search_log": 4,
    "window_log": 18,
    "chain_log": 16,
    "hash_log": 16,
    "write_content_size": False,
}

_NOT_LETTERS = re.compile(r"[\W\d_]+")


def _plain(text: str) -> bytes:
    return f" {_NOT_LETTERS.sub(' ', text.lower()).strip()} ".encode()


def _has_letter(text: str | None) -> bool:
    """Whether a text has a letter; numerals such as ``Ⅷ`` and ``½`` are none."""
    return any(map(str.isalpha, text or ""))


@dataclass
class LanguageModel:
    """The raw content of each language's dictionary."""

    contents: dict[str, bytes]

    def __getstate__(self) -> dict:
        return {"contents": self.contents}

    @cached_property
    def _compressors(self) -> dict[str, zstandard.ZstdCompressor]:
        made, how = {}, zstandard.ZstdCompressionParameters(**_PARAMETERS)
        for lang, content in sorted(self.contents.items()):
            entries = zstandard.ZstdCompressionDict(
                content, dict_type=zstandard.DICT_TYPE_RAWCONTENT
            )
            entries.precompute_compress(compression_params=how)
            made[lang] = zstandard.ZstdCompressor(dict_data=entries, compression_params=how)
        return made

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score and whether the margin is too narrow.

        The score is the winner's share when every language counts with
        2 ** (-(excess length in percent)); with one language it is 1. Texts that
        are NULL or have no letter, or any text if no language was learned, are
        ``und`` with score 0 and rejected. Ties go to the first name.
        """
        if not self.contents or not _has_letter(text):
            return UNKNOWN, 0.0, True
        plain = _plain(text)
        parts = [plain[i : i + WINDOW] for i in range(0, len(plain), WINDOW)]
        sizes = {
            lang: sum(len(c.compress(p)) for p in parts)
            for lang, c in self._compressors.items()
        }
        best = min(sizes, key=sizes.get)
        excess = np.array([s / sizes[best] - 1 for s in sizes.values()])
        margin = np.sort(excess)[1] if len(excess) > 1 else 1.0
        score = 1 / np.sum(np.exp2(-np.minimum(100 * excess, 1000)))
        return best, float(score), bool(margin < MIN_MARGIN)


def consistent(rows: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """Rows whose label a model made of the other half of the rows confirms.

    A text under the wrong label would draw all its copies to that language.
    Without any confirmed row of a language its rows all stay.
    """
    halves = rows[::2], rows[1::2]
    models = [contents_of(half) for half in halves]
    kept = [
        (lang, text)
        for half, other in zip(halves, reversed(models))
        for lang, text in half
        if other.predict(text)[0] == lang
    ]
    confirmed = {lang for lang, _ in kept}
    return kept + [row for row in rows if row[0] not in confirmed]


def contents_of(rows: list[tuple[str, str]]) -> LanguageModel:
    """A model from (language, text) pairs.

    A dictionary is filled with equal shares of its texts, so that no long
    document crowds out the others; texts without a letter teach nothing.
    """
    texts: dict[str, list[bytes]] = {}
    for lang, text in rows:
        if _has_letter(text):
            texts.setdefault(lang, []).append(_plain(text))
    share = {k: max(256, DICTIONARY_BYTES // len(v)) for k, v in texts.items()}
    return LanguageModel(
        {k: b"".join(t[: share[k]] for t in v)[-DICTIONARY_BYTES:] for k, v in texts.items()}
    )


def fit(docs: DataFrame) -> LanguageModel:
    """Learn every language of ``docs(lang, text)`` from a bounded sample.

    Takes about SAMPLE_DOCS documents of each language, chosen by a hash of the
    text; NULL texts and languages and very long texts are not sampled.
    """
    known = docs.select("lang", "text").where(
        F.col("lang").isNotNull() & (F.length("text") <= MAX_SAMPLE_CHARS)
    )
    totals = known.groupBy("lang").agg(F.count("*").alias("n")).collect()
    wanted = F.lit(False)
    for row in totals:
        wanted |= (F.col("lang") == row["lang"]) & spread_sample(
            F.col("text"), 2 * SAMPLE_DOCS, row["n"]
        )
    found = known.where(wanted).distinct().collect()
    found.sort()
    taken: dict[str, int] = {}
    pairs = []
    for row in found:
        taken[row["lang"]] = taken.get(row["lang"], 0) + 1
        if taken[row["lang"]] <= 2 * SAMPLE_DOCS:
            pairs.append((row["lang"], row["text"]))
    return contents_of(consistent(pairs))


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` and ``rejected`` of every row.

    Whole texts are compressed. NULL ids stay NULL, repeated rows each get a row,
    other columns are ignored, an empty table gives an empty table.
    """

    def run(texts: list[str | None]) -> dict:
        found = [model.predict(t) for t in texts]
        names = ("lang_pred", "score", "rejected")
        return {name: [f[i] for f in found] for i, name in enumerate(names)}

    return map_texts(docs, run, "lang_pred string, score double, rejected boolean")


def held_out_split(id_column: str = "doc_id"):
    """The rows never used for learning: crc32 of the id as text, mod 4, is 2."""
    return remainder_is(F.col(id_column), 4, 2)
