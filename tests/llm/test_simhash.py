import random

import numpy as np
import pytest
import xxhash
from conftest_words import lower, split

from refrain.llm import simhash


def plain_fingerprint(text):
    words = split(lower(text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum((sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) << b for b in range(64))


def plain_components(prints):
    """Smallest id reachable for each (id, fingerprint)."""
    label = list(range(len(prints)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, (_, a) in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j][1]).bit_count() <= 3:
                label[top(i)] = top(j)
    least = {}
    for i, (doc, _) in enumerate(prints):
        if doc is not None:
            least[top(i)] = min(doc, least.get(top(i), doc))
    return [(doc, f"{p:016x}", least.get(top(i))) for i, (doc, p) in enumerate(prints)]


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def flipped(rng, point, bits):
    for b in rng.sample(range(64), bits):
        point ^= 1 << b
    return point


def clustered(rng, groups=40, size=30, bits=4):
    """Fingerprints around centres, one of them with a third of all."""
    points = []
    for g in range(groups):
        centre = rng.getrandbits(64)
        count = size * groups // 2 if g == 0 else rng.randint(1, size)
        points += [flipped(rng, centre, rng.randint(0, bits)) for _ in range(count)]
    return sorted(set(points))


def test_fingerprints_match_their_definition():
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["Aé", "b.", "CC", "ÀÉ", "ddd"]) for _ in range(n)) for n in range(60)]
    texts += [None, "", " \t\n\x0b", "one", "one\x1ftwo", "one two three", "x " * 70_000]
    for text in texts:
        data = None if text is None else text.encode()
        assert simhash.fingerprint(data) == plain_fingerprint(text)


@pytest.mark.parametrize("shards", [1, 2, 7, 32])
def test_shards_tie_what_links_tie(shards):
    rng = random.Random(shards)
    points = np.array(clustered(rng), np.uint64)
    nodes = simhash.upper_tree(points[:: 3], shards)
    row, shard, home = simhash.dealt(points, nodes)
    assert sorted(row[home].tolist()) == list(range(len(points)))
    label = list(range(len(points)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for s in set(shard.tolist()):
        mine = row[shard == s]
        found = simhash.forest(points[mine], home[shard == s])
        for i, j in enumerate(found):
            a, b = top(mine[i]), top(mine[j])
            label[max(a, b)] = min(a, b)
    plain = plain_components([(i, int(p)) for i, p in enumerate(points)])
    assert [top(i) for i in range(len(points))] == [r[2] for r in plain]


def test_equal_distances_still_split():
    points = np.array([1 << i for i in range(64)] + [(1 << 63) + 1], np.uint64)
    assert (simhash.forest(points, np.ones(len(points), bool)) == 0).all()


def test_near_copies_match_brute_force(frame, repetitive):
    rows = repetitive + [(900 + i, None) for i in range(5)]
    got = simhash.near_copies(frame(rows)).collect()
    want = plain_components([(i, plain_fingerprint(t)) for i, t in rows])
    assert ordered(got) == ordered(want)


def test_many_shards_and_parts_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD", 100)
    monkeypatch.setattr(simhash, "PART", 60)
    points = clustered(random.Random(11))
    signed = [(int(np.uint64(p).view(np.int64)),) for p in points]
    classes = spark.createDataFrame(signed, "fp bigint").repartition(5)
    from refrain.llm.components import components

    found = {r.node: r.component for r in components(simhash.links(classes)).collect()}
    by_label, plain = {}, {}
    for (fp,), (_, _, c) in zip(signed, plain_components(list(enumerate(points)))):
        by_label.setdefault(found.get(fp, fp), set()).add(fp)
        plain.setdefault(c, set()).add(fp)
    assert sorted(map(sorted, by_label.values())) == sorted(map(sorted, plain.values()))


def test_empty_table(frame):
    assert simhash.near_copies(frame([], 1)).collect() == []


def test_a_very_large_group_of_near_copies():
    rng = random.Random(5)
    centre = rng.getrandbits(64)
    points = np.array(sorted({flipped(rng, centre, rng.randint(0, 3)) for _ in range(30_000)}), np.uint64)
    assert (simhash.forest(points, np.ones(len(points), bool)) == 0).all()
