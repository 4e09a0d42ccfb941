"""Window and suffix deduplication against plain readings of their contracts."""

import hashlib
import random
import time
from collections import Counter

import pytest
from conftest import words
from conftest_words import colliding_words, split

from refrain.llm import suffix_dedup, window_dedup


def by_windows(rows, width):
    order = sorted({(-1 if i is None else i, t or "") for i, t in rows})
    first = {}
    for key in order:
        items = split(key[1])
        for s in range(len(items) - width + 1):
            first.setdefault(tuple(items[s : s + width]), (key, s))
    found = []
    for i, t in rows:
        key, items = (-1 if i is None else i, t or ""), split(t or "")
        gone = set()
        for s in range(len(items) - width + 1):
            if first[tuple(items[s : s + width])] != (key, s):
                gone |= set(range(s, s + width))
        kept = " ".join(w for j, w in enumerate(items) if j not in gone)
        found.append((i, len(items), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return Counter(found)


@pytest.mark.parametrize("width", [6, 20])
def test_windows(frame, repetitive, width):
    got = window_dedup.remove_repeats(frame(repetitive), width=width, gram=3)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    assert Counter(map(tuple, got.collect())) == by_windows(repetitive, width)


def by_bytes(rows, width):
    data = [(i, (t or "").encode()) for i, t in rows]
    times = Counter(b[s : s + width] for _, b in data for s in range(len(b) - width + 1))
    found = []
    for i, b in data:
        gone = [False] * len(b)
        for s in range(len(b) - width + 1):
            if times[b[s : s + width]] > 1:
                gone[s : s + width] = [True] * width
        kept = bytes(c for c, g in zip(b, gone) if not g)
        runs = sum(g and not (j and gone[j - 1]) for j, g in enumerate(gone))
        found.append((i, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return Counter(found)


@pytest.mark.parametrize("width, gram, max_group", [(30, 8, 500), (40, 12, 3)])
def test_suffixes(frame, repetitive, width, gram, max_group):
    got = suffix_dedup.remove_repeats(frame(repetitive), width=width, gram=gram, max_group=max_group)
    assert Counter(map(tuple, got.collect())) == by_bytes(repetitive, width)


def test_split_groups_are_stored_step_by_step(frame, repetitive, monkeypatch):
    split, made = suffix_dedup._split_groups, []
    monkeypatch.setattr(suffix_dedup, "_split_groups", lambda *a: made.append(split(*a)) or made[0])
    suffix_dedup.remove_repeats(frame(repetitive), width=40, gram=12, max_group=3)
    whole, small = made[0]
    assert len(whole) == len(small) > 1
    assert all("Join" not in f._jdf.queryExecution().toString() for f in whole + small)


def test_a_halving_step_writes_three_tables(frame, repetitive, monkeypatch):
    """Hadoop starts processes for each file that is made."""
    stored, names = suffix_dedup.stored, []
    monkeypatch.setattr(suffix_dedup, "stored", lambda df, name: names.append(name) or stored(df, name))
    split, made = suffix_dedup._split_groups, []

    def watched(*args):
        before = len(names)
        whole, small = split(*args)
        made.append((len(whole), len(names) - before))
        return whole, small

    monkeypatch.setattr(suffix_dedup, "_split_groups", watched)
    got = suffix_dedup.remove_repeats(frame(repetitive), width=40, gram=12, max_group=3)
    assert Counter(map(tuple, got.collect())) == by_bytes(repetitive, 40)
    steps, tables = made[0]
    assert steps > 1 and tables <= 3 * steps


def test_words_that_collide_modulo_powers_of_two(frame):
    one, other = colliding_words()
    around = [f"w{i}" for i in range(30)]
    rows = [(n, " ".join(around[:10] + [w] + around[10:20])) for n, w in enumerate((one, other))]
    got = window_dedup.remove_repeats(frame(rows), width=20, gram=5)
    assert {r["n_removed"] for r in got.collect()} == {0}
    rows = [(0, "a" * 40 + one), (1, "b" * 40 + other)]
    got = suffix_dedup.remove_repeats(frame(rows), width=900, gram=32)
    assert Counter(map(tuple, got.collect())) == by_bytes(rows, 900)


def test_columns_named_like_helpers(frame):
    docs = frame([(1, "a" * 60), (2, "a" * 60), (3, None)])
    docs = docs.withColumnRenamed("class", "TEXT_is_null").withColumnRenamed("start", "rest")
    got = suffix_dedup.cut_repeats(docs, width=41, gram=9)
    assert got.columns == docs.columns
    assert {(r["doc_id"], r["text"], r["TEXT_is_null"], r["rest"]) for r in got.collect()} == {
        (1, "", "c", "x"), (2, "", "c", "x"), (3, None, "c", "x")
    }


def test_empty_tables(frame):
    assert window_dedup.remove_repeats(frame([])).collect() == []
    assert suffix_dedup.remove_repeats(frame([])).collect() == []


def test_cut_repeats_keeps_columns(frame):
    shared = "é" * 60
    docs = frame([(1, "a" + shared + "b"), (2, "cc" + shared), (3, None), (4, "plain")])
    got = suffix_dedup.cut_repeats(docs, width=41, gram=9)
    assert got.columns == docs.columns
    rows = {r["doc_id"]: r for r in got.collect()}
    assert rows[1]["text"] == "ab" and rows[2]["text"] == "cc" and rows[1]["n_chars"] == 2
    assert rows[3]["text"] is None and rows[4]["text"] == "plain" and rows[4]["class"] == "c"


def test_maximal_repeats_cover_all_repeated_windows():
    for seed in range(150):
        rng = random.Random(seed)
        base = bytes(rng.choice(b"ab") for _ in range(60))
        texts = []
        for _ in range(rng.randint(1, 6)):
            a = rng.randint(0, 50)
            ends = (bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 20))) for _ in "xy")
            texts.append(next(ends) + base[a : rng.randint(a, 60)] + next(ends))
        width = rng.randint(1, 12)
        joined, repeats = suffix_dedup.maximal_repeats(texts, width)
        got = {p for r in repeats for s in r.starts for p in range(s, s + r.length)}
        times = Counter(t[s : s + width] for t in texts for s in range(len(t) - width + 1))
        expected = {
            int(b) + p
            for t, b in zip(texts, joined.begin)
            for s in range(len(t) - width + 1) if times[t[s : s + width]] > 1
            for p in range(s, s + width)
        }
        assert got == expected
        for r in repeats:
            assert len({joined.data[s : s + r.length].tobytes() for s in r.starts}) <= 1


def test_interval_is_left_diverse_and_lists_all_occurrences():
    joined, repeats = suffix_dedup.maximal_repeats([b"xabcdeY", b"yabcdeZ", b"zabcdQ"], 3)
    found = {(r.length, tuple(sorted(joined.data[s - 1 : s].tobytes() for s in r.starts)), r.parent) for r in repeats}
    assert found == {(5, (b"x", b"y"), 4), (4, (b"x", b"y", b"z"), 0)}


def maximal_groups(texts, width):
    """Strings of at least ``width`` bytes that occur twice, with different bytes (or
    the end of a text) on both sides, and all places where they occur."""
    places = {}
    for t, text in enumerate(texts):
        for a in range(len(text)):
            for b in range(a + width, len(text) + 1):
                places.setdefault(text[a:b], []).append((t, a))

    def sides(word, found):
        left = {texts[t][a - 1] if a else (t, "start") for t, a in found}
        ends = ((t, a + len(word)) for t, a in found)
        right = {texts[t][e] if e < len(texts[t]) else (t, "end") for t, e in ends}
        return len(left) > 1 and len(right) > 1

    return {w: sorted(found) for w, found in places.items() if len(found) > 1 and sides(w, found)}


def test_maximal_repeat_groups_equal_brute_force():
    for seed in range(300):
        rng = random.Random(seed)
        texts = [
            bytes(rng.choice(b"ab\n"[: rng.randint(1, 3)]) for _ in range(rng.randint(0, 25)))
            for _ in range(rng.randint(1, 6))
        ]
        width = rng.randint(1, 6)
        joined, repeats = suffix_dedup.maximal_repeats(texts, width)
        got = {}
        for r in repeats:
            owner = joined.begin.searchsorted(r.starts, "right") - 1
            word = joined.data[r.starts[0] : r.starts[0] + r.length].tobytes()
            assert word not in got
            got[word] = sorted(zip(owner.tolist(), (r.starts - joined.begin[owner]).tolist()))
        assert got == maximal_groups(texts, width), (seed, texts, width)


def test_equal_rows_take_time_in_proportion(frame):
    """Rows that repeat id and text share runs with other documents, open and closed."""
    rng = random.Random(3)
    many = [f"w{i}" for i in range(300)]
    passage, tail = words(rng, 40, many), words(rng, 30, many)
    text = f"{words(rng, 20, many)} {passage} {tail}"
    rows = [(1, f"x {passage} y"), (2, f"{words(rng, 5, many)} {passage} {tail[:80]} z")]
    rows += [(None, text)] * 1500 + [(5, text)] * 1500
    seconds = []
    for some in ([(i if i is None else i + 10 * n, t) for n, (i, t) in enumerate(rows)], rows):
        begun = time.monotonic()
        got = suffix_dedup.remove_repeats(frame(some), width=40, gram=12).collect()
        later = window_dedup.remove_repeats(frame(some), width=20, gram=3).collect()
        seconds.append(time.monotonic() - begun)
        assert len(got) == len(later) == len(rows)
    assert {r["n_removed"] for r in got if r["doc_id"] in (None, 5)} == {len(text)}
    found = {(r["doc_id"], r["n_removed"]) for r in later}
    assert len(found) == 4 and (None, 0) in found and (5, len(split(text))) in found
    assert seconds[1] < 3 * seconds[0] + 10


def test_line_feeds_in_texts_do_not_hide_repeats():
    joined, repeats = suffix_dedup.maximal_repeats([b"ab\nb", b"ab\nz", b"ab", b"mq"], 2)
    gone = {p for r in repeats for s in r.starts for p in range(s, s + r.length)}
    assert gone == {0, 1, 2, 5, 6, 7, 10, 11}
    for seed in range(400):
        rng = random.Random(seed)
        base = bytes(rng.choice(b"a\n\0") for _ in range(30))
        texts = []
        for _ in range(rng.randint(2, 8)):
            a = rng.randint(0, 25)
            texts.append(base[a : rng.randint(a, 30)] + bytes(rng.choice(b"a\n\0z") for _ in range(rng.randint(0, 4))))
        width = rng.randint(1, 12)
        joined, repeats = suffix_dedup.maximal_repeats(texts, width)
        got = {p for r in repeats for s in r.starts for p in range(s, s + r.length)}
        times = Counter(t[s : s + width] for t in texts for s in range(len(t) - width + 1))
        assert got == {
            int(b) + p
            for t, b in zip(texts, joined.begin)
            for s in range(len(t) - width + 1) if times[t[s : s + width]] > 1
            for p in range(s, s + width)
        }, (seed, texts, width)
