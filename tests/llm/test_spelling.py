import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from refrain.llm import spelling


def plain_words(rows, every):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if every and h % every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= 6:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 5}


def plain_near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(counts):
    form, near = {}, {}
    for w, n in counts.items():
        around = [x for x in counts if plain_near(w, x)]
        near[w] = len(around)
        best = min(around, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best and counts[best] >= 5 * n else None
    rows = []
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, form[w], root, n, near[w], counts[form[w]] if form[w] else None))
    return sorted(rows)


def noisy(rng, words, alphabet="abcdeé×ÿ"):
    """Words and edited words, some often."""
    out = []
    for word in words:
        for _ in range(rng.randint(1, 3)):
            x = list(word)
            for _ in range(rng.randint(0, 2)):
                at = rng.randrange(len(x))
                kind = rng.randrange(3)
                if kind == 0:
                    x[at] = rng.choice(alphabet)
                elif kind == 1:
                    del x[at]
                else:
                    x.insert(at, rng.choice(alphabet))
            out += ["".join(x)] * rng.choice([1, 5, 6, 30, 200])
    rng.shuffle(out)
    return out


def corpus(seed, base=60, letters="abcdeé×"):
    rng = random.Random(seed)
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(5, 9))) for _ in range(base)]
    tokens = noisy(rng, words)
    rows = [(i, " ".join(tokens[i::20]).replace("a", "A")) for i in range(20)]
    return rows + [(None, rows[0][1]), (3, rows[3][1]), (90, None), (91, ""), (92, " \n 123 !!")]


@pytest.mark.parametrize("every", [0, 3, 199])
def test_variants_match_brute_force(frame, every):
    rows = corpus(every) + [(95, ("z" * 3000 + " ") * 5 + ("z" * 2999 + " ") * 25)]
    got = sorted(map(tuple, spelling.variants(frame(rows), every).collect()))
    assert got == plain_variants(plain_words(rows, every))


def test_many_shards_and_parts_give_the_same(frame, monkeypatch):
    for name, value in (("SHARD", 8), ("PART", 20), ("MOST_SHARDS", 6), ("LEAF", 4)):
        monkeypatch.setattr(spelling, name, value)
    rows = corpus(8, 150, "abc")
    got = sorted(map(tuple, spelling.variants(frame(rows)).collect()))
    assert got == plain_variants(plain_words(rows, 0))


@pytest.mark.parametrize("seed", range(6))
def test_trees_find_all_near_words(seed):
    rng = random.Random(seed)
    words = {"".join(rng.choice("abcdéü"[: 3 + seed % 4]) for _ in range(rng.randint(6, 7))) for _ in range(900)}
    for size in (6, 7):
        here = sorted(w for w in words if len(w) == size)
        x = spelling.vectors(spelling.letters(here))
        nodes = spelling.upper_tree(x[::2], 9)
        row, shard, far = spelling.touched(x, nodes, 2)
        assert sorted(row[far == 0].tolist()) == list(range(len(here)))
        meets = {}
        for r, s in zip(row, shard):
            meets.setdefault(r, set()).add(s)
        home = dict(zip(row[far == 0], shard[far == 0]))
        for i, a in enumerate(here):
            assert all(home[j] in meets[i] for j, b in enumerate(here) if plain_near(a, b))
    both = sorted(words)
    short = np.array([len(w) == 6 for w in both])
    found = spelling.near_within(both, [1] * len(both), short)
    want = [sum(plain_near(w, x) for x in both if len(x) == 6 or len(w) == 6) for w in both]
    assert found.count.tolist() == want


def test_equal_letter_counts_need_no_split():
    words = ["".join(w) for w in __import__("itertools").permutations("abcdef")]
    found = spelling.near_within(words, [1] * len(words), np.ones(len(words), bool))
    assert not found.count.any()


def test_empty_tables(frame):
    assert spelling.variants(frame([], 1)).collect() == []
    assert spelling.variants(frame([(1, None), (2, "rare words")], 1)).collect() == []
