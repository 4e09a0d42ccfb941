"""Words, windows and their rolling hashes, for many texts at once.

Texts are handled as UTF-8 bytes, joined with line feeds, in numpy. Sums of
``code * base ** position`` modulo the prime 2 ** 61 - 1 give the Rabin-Karp hash of
any range of bytes or words in constant time. (Modulo a power of two, some strings
of 1,024 bytes hash alike whatever the base.)
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

#: Bytes of text handled at once; arrays take about fifty times as much memory.
CHUNK_BYTES = 1 << 18

#: Hashes are taken modulo this prime.
_PRIME = np.uint64((1 << 61) - 1)
_BASE = 0x0D3A5C91E47B26F9
_UNBASE = pow(_BASE, -1, int(_PRIME))
_LENGTH = np.uint64(0x9E3779B97F4A7C15)
_powers: dict[int, np.ndarray] = {}

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


_LOW_30, _LOW_31, _LOW_62 = (np.uint64((1 << n) - 1) for n in (30, 31, 62))
_1, _30, _31, _61 = (np.uint64(n) for n in (1, 30, 31, 61))


def _fold(x: np.ndarray) -> np.ndarray:
    """x modulo the prime, for any 64-bit x."""
    folded = x >> _61
    folded += x & _PRIME
    return np.minimum(folded, folded - _PRIME)  # below the prime the difference wraps


#: Items multiplied at once, few enough to stay in a core's cache.
_BLOCK = 1 << 13


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo the prime, by halves of 31 bits; a below 2 ** 62, b below the prime."""
    made = np.empty(len(a), np.uint64)
    for at in range(0, len(a), _BLOCK):
        x = a[at : at + _BLOCK]
        y = b[at : at + len(x)] if b.ndim else b
        high_x, low_x, high_y, low_y = x >> _31, x & _LOW_31, y >> _31, y & _LOW_31
        middle = high_x * low_y
        middle += low_x * high_y
        # 2 ** 61 is 1 modulo the prime, so 2 ** 62 is 2.
        high_x *= high_y
        high_x <<= _1
        high_x += middle >> _30
        middle &= _LOW_30
        middle <<= _31
        high_x += middle
        low_x *= low_y
        high_x += low_x
        made[at : at + _BLOCK] = _fold(high_x)
    return made


def _prefix_sums(values: np.ndarray) -> np.ndarray:
    """Sums of the first 0, 1, 2, ... values (below the prime) modulo the prime."""
    sums = np.zeros(len(values) + 1, np.uint64)
    for at in range(0, len(values), _BLOCK):
        block = values[at : at + _BLOCK]
        low, high = np.cumsum(block & _LOW_31), np.cumsum(block >> _31)
        low += high >> _30
        high &= _LOW_30
        high <<= _31
        low += high
        low += sums[at]
        sums[at + 1 : at + 1 + len(block)] = _fold(low)
    return sums


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0 up to base ** n modulo the prime, kept between calls."""
    known = _powers.get(base, np.ones(1, np.uint64))
    while len(known) <= n:
        step = np.uint64(pow(base, len(known), int(_PRIME)))
        known = np.r_[known, _times(known, step)]
    _powers[base] = known
    return known


def mix(values: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values evenly (the finaliser of a well-known generator)."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_CODES = _fold(mix(np.arange(1, 257)))


class RangeHash:
    """Hashes of ranges of a sequence of 64-bit codes."""

    def __init__(self, codes: np.ndarray):
        """Of each code the low 62 bits count, modulo the prime."""
        self._sums = _prefix_sums(_times(codes & _LOW_62, _power(_BASE, len(codes))))

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        start = np.asarray(start)
        found = _times(
            self._sums[end] + (_PRIME - self._sums[start]),
            _power(_UNBASE, len(self._sums))[start],
        )
        return mix(found + (np.asarray(end) - start).astype(np.uint64) * _LENGTH)


def byte_codes(data: np.ndarray) -> np.ndarray:
    return _CODES[data]


@dataclass
class Texts:
    """Several texts as one array of bytes; text i is ``data[begin[i]:end[i]]``."""

    data: np.ndarray
    begin: np.ndarray
    end: np.ndarray

    @classmethod
    def join(cls, texts: list[bytes]) -> Texts:
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        end = np.cumsum(sizes + 1) - 1
        return cls(np.frombuffer(b"\n".join(texts) + b"\n", np.uint8), end - sizes, end)


@dataclass
class Words:
    """The words of joined texts: byte ranges, and the first word of each text."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # of text i; one more entry than texts

    @classmethod
    def of(cls, texts: Texts, is_gap: np.ndarray = _SPACE) -> Words:
        inside = np.r_[False, ~is_gap[texts.data], False]
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        start, end = edges[::2], edges[1::2]
        return cls(start, end, np.searchsorted(start, np.r_[texts.begin, len(texts.data)]))

    def text_of(self) -> np.ndarray:
        """The text that each word is in."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def window_starts(
    begin: np.ndarray, end: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """Start of every window of ``width`` items within a text, and its text.

    Items of text i are ``begin[i]`` to ``end[i]``.
    """
    counts = np.maximum(end - begin - width + 1, 0)
    text = np.repeat(np.arange(len(counts)), counts)
    skipped = np.cumsum(counts) - counts
    return np.arange(counts.sum()) - skipped[text] + begin[text], text


@dataclass
class Runs:
    """Consecutive windows that share an anchor, the smallest gram hash in them.

    Equal windows have equal anchors at equal places, wherever they are.
    """

    text: np.ndarray
    start: np.ndarray  # item at which the first window starts
    count: np.ndarray  # windows
    anchor: np.ndarray  # hash of the anchor
    content: np.ndarray  # hash of all items of the run and the anchor's place


def anchored_runs(
    codes: np.ndarray, begin: np.ndarray, end: np.ndarray, width: int, gram: int
) -> Runs:
    """All windows of ``width`` items, as runs; grams have ``gram`` items."""
    starts, text = window_starts(begin, end, width)
    if not len(starts):
        none = np.empty(0, np.int64)
        return Runs(none, none, none, none.view(np.uint64), none.view(np.uint64))
    ranges = RangeHash(codes)
    place = np.arange(len(codes) - gram + 1)
    grams = ranges(place, place + gram)
    # The place in the low bits makes the leftmost of equal hashes the smallest.
    low = np.uint64((1 << len(codes).bit_length()) - 1)
    smallest = (grams & ~low) | place.astype(np.uint64)
    span, reach = width - gram + 1, 1
    while 2 * reach <= span:
        smallest = np.minimum(smallest[:-reach], smallest[reach:])
        reach *= 2
    if reach < span:
        smallest = np.minimum(smallest[: len(smallest) - span + reach], smallest[span - reach :])
    at = (smallest[starts] & low).astype(np.int64)
    new = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (text[1:] != text[:-1])])
    start, at, count = starts[new], at[new], np.diff(np.r_[new, len(starts)])
    content = ranges(start, start + count - 1 + width) ^ mix((at - start).astype(np.uint64))
    return Runs(text[new], start, count, grams[at], content)


def chunks(texts: list[str | None]) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive texts as UTF-8 up to CHUNK_BYTES, with the number of the first.

    NULL counts as empty. A longer text comes alone.
    """
    taken, size, first = [], 0, 0
    for number, text in enumerate(texts):
        data = (text or "").encode("utf-8", "surrogatepass")
        if taken and size + len(data) > CHUNK_BYTES:
            yield first, taken
            taken, size, first = [], 0, number
        taken.append(data)
        size += len(data) + 1
    if taken:
        yield first, taken


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of n items lie in a window of ``width`` from one of ``starts``."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, np.minimum(starts + width, n), -1)
    return np.cumsum(change[:-1]) > 0
