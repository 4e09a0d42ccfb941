"""N-gram join, components and decontamination against plain readings."""

import random
from collections import Counter

import numpy as np
import pytest
from conftest_words import colliding_words, lower, split

from refrain.llm import decontamination, ngram_join
from refrain.llm.components import components


def shingles(text, n=5):
    items = split(lower(text or ""))
    if len(items) < n:
        return frozenset([tuple(items)] if items else [])
    return frozenset(tuple(items[i : i + n]) for i in range(len(items) - n + 1))


def groups(rows, similarity):
    sets = [(i, shingles(t)) for i, t in rows]
    head = list(range(len(rows)))

    def top(x):
        while head[x] != x:
            x = head[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= similarity * len(x | y):
                head[top(a)] = top(b)
    least = {}
    for n, (i, _) in enumerate(sets):
        if i is not None:
            least[top(n)] = min(i, least.get(top(n), i))
    return Counter((i, len(s), least.get(top(n))) for n, (i, s) in enumerate(sets))


@pytest.mark.parametrize("similarity, block_rows, rounds", [(80, 2000, ngram_join.TAKEN), (60, 4, (1,))])
def test_join(frame, repetitive, similarity, block_rows, rounds):
    got = ngram_join.join_documents(frame(repetitive), similarity=similarity, block_rows=block_rows, rounds=rounds)
    rows = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect())
    assert rows == groups(repetitive, similarity)


def test_keep_one(frame, repetitive):
    docs = frame(repetitive)
    got = ngram_join.keep_one(docs)
    assert got.columns == docs.columns
    kept = sorted(r["doc_id"] for r in got.collect() if r["doc_id"] is not None)
    firsts = sorted({c for _, n, c in groups(repetitive, 80) if n} | {73, 74, 75})
    assert kept == firsts


def test_words_that_collide_modulo_powers_of_two(frame):
    rows = [(n, f"one two {w} three four five") for n, w in enumerate(colliding_words())]
    got = ngram_join.join_documents(frame(rows)).collect()
    assert {(r["doc_id"], r["component_id"]) for r in got} == {(0, 0), (1, 1)}


def test_keep_one_keeps_columns_named_like_helpers(frame):
    docs = frame([(1, "one two"), (2, "one two"), (3, None)])
    docs = docs.withColumnRenamed("class", "kept_key").withColumnRenamed("start", "key")
    got = ngram_join.keep_one(docs)
    assert got.columns == docs.columns
    assert {(r["doc_id"], r["kept_key"], r["key"]) for r in got.collect()} == {(1, "c", "x"), (3, "c", "x")}
    assert ngram_join.keep_one(docs.limit(0)).collect() == []


def test_join_of_nothing(frame):
    assert ngram_join.join_documents(frame([])).collect() == []


def test_tree_bound_never_loses_a_pair():
    rng = random.Random(3)
    texts = []
    for _ in range(40):
        base = [f"t{rng.randrange(500)}" for _ in range(rng.randint(5, 90))]
        for _ in range(4):
            near = list(base)
            near[rng.randrange(len(near))] = f"n{rng.randrange(9)}"
            texts.append(" ".join(near).encode())
    sets = ngram_join.Sets(texts, 5)
    points, sizes = sets.points(), sets.sizes()
    tree = ngram_join.CountTree(points, sizes)
    for i in range(len(texts)):
        found = set(tree.search(points[i], int(sizes[i]), 80)[0].tolist())
        for j in range(len(texts)):
            shared = len(set(sets[i].tolist()) & set(sets[j].tolist()))
            if 100 * shared >= 80 * (sizes[i] + sizes[j] - shared):
                assert j in found


def test_points_tell_what_is_not_similar_enough():
    rng = random.Random(5)
    base = [f"t{i}" for i in range(300)]
    texts = []
    for n in range(30):  # any two share about two thirds of their shingles
        near = list(base)
        for at in rng.sample(range(300), 6):
            near[at] = f"n{n}x{at}"
        texts.append(" ".join(near).encode())
    sets = ngram_join.Sets(texts, 5)
    points, sizes = sets.points(), sets.sizes()
    tree = ngram_join.CountTree(points, sizes)
    found = similar = 0
    for i in range(30):
        found += len(tree.search(points[i], int(sizes[i]), 80)[0])
        for j in range(30):
            shared = len(np.intersect1d(sets[i], sets[j]))
            similar += 100 * shared >= 80 * (sizes[i] + sizes[j] - shared)
    assert similar <= found <= similar + 90


def test_keys_met_twice_are_found_over_several_passes():
    rng = np.random.default_rng(2)
    keys, owner = rng.integers(0, 300, 400), np.arange(400)
    met, found = ngram_join._Met(), []
    for at in range(0, 400, 37):
        met.add(keys[at : at + 37], owner[at : at + 37])
        found += [tuple(r.values()) for r in met.shared().to_pylist()]
    times = Counter(keys.tolist())
    assert sorted(found) == sorted((k, o) for k, o in zip(keys.tolist(), owner.tolist()) if times[k] > 1)


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)]
    head = {}

    def top(x):
        while head.setdefault(x, x) != x:
            x = head[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = top(a), top(b)
            head[max(a, b)] = min(a, b)
    table = spark.createDataFrame(edges, "a bigint, b bigint").repartition(5)
    got = {r["node"]: r["component"] for r in components(table).collect()}
    assert got == {x: top(x) for x in head}


def test_contained_items(spark, frame):
    rng = random.Random(5)
    items = [(i, " ".join(f"k{rng.randrange(900)}" for _ in range(rng.randint(3, 50)))) for i in range(25)]
    rows = []
    for i in range(60):
        text = [f"d{rng.randrange(900)}" for _ in range(rng.randint(0, 200))]
        if i % 3 == 0:
            leak = items[i % 25][1].split()
            for _ in range(i % 4):
                leak[rng.randrange(len(leak))] = "Changed"
            text[5:5] = [w.upper() + "," for w in leak]
        rows.append((i, " ".join(text)))
    rows += [(90, None), (91, ""), (None, items[4][1]), (92, items[4][1]), (92, items[4][1])]
    table = spark.createDataFrame(items + [(99, None), (98, "")], "item_id bigint, text string")
    got = decontamination.contained_items(frame(rows), table)

    def plain(text):
        return "".join(c if c.isalnum() else " " for c in lower(text or "")).split()

    def sets(text):
        w = plain(text)
        return {tuple(w[j : j + 5]) for j in range(len(w) - 4)}

    expected = Counter()
    for i, t in rows:
        held = sets(t)
        for k, text in items:
            item = sets(text)
            if item and len(item & held) >= 0.8 * len(item) - 1e-9:
                expected[i, k, len(item & held), len(item)] += 1
    assert expected
    assert Counter((r["doc_id"], r["item_id"], r["n_shared"], r["n_shingles"]) for r in got.collect()) == expected
    clean = decontamination.drop_contaminated(frame(rows), table)
    assert Counter(r["doc_id"] for r in clean.collect()) == Counter(
        i for i, t in rows if i not in {e[0] for e in expected}
    )
    assert decontamination.contained_items(frame(rows), table.limit(0)).collect() == []
    assert decontamination.contained_items(frame([]), table).collect() == []
