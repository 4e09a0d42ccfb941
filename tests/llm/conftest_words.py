"""Plain helpers of the tests."""

import re

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def lower(text):
    return text.translate(str.maketrans(_UPPER, _UPPER.lower()))


def colliding_words():
    """Two words of 1,024 bytes (the Thue-Morse word and its complement) that every
    polynomial hash modulo 2 ** 64 takes as equal."""
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    return word, word.translate(str.maketrans("ab", "ba"))
