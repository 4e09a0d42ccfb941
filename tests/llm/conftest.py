import random

import pytest

WORDS = "alpha Beta gamma, delta! épsilon zeta eta; theta iota kappa".split()


def words(rng: random.Random, n: int, vocabulary=WORDS) -> str:
    return " ".join(rng.choice(vocabulary) for _ in range(n))


@pytest.fixture(scope="session")
def frame(spark):
    """Makes a table of documents, in several partitions, with columns whose names
    clash with those that operators make."""

    def make(rows, partitions=3):
        schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, class string, start string"
        full = [(i, t, "en", f"s{(i or 0) % 2}", len(t or ""), None, "c", "x") for i, t in rows]
        return spark.createDataFrame(full, schema).repartition(partitions)

    return make


@pytest.fixture(scope="session")
def repetitive():
    """Documents with copies, near copies, shared passages, NULLs and blanks."""
    rng = random.Random(7)
    many = [f"w{i}" for i in range(400)]
    base = words(rng, 60, many)
    passage = words(rng, 15, many)
    rows = [(i, words(rng, rng.randint(0, 50), many)) for i in range(30)]
    rows += [(30 + i, words(rng, 10, many) + "\n" + passage + " " + words(rng, 8, many)) for i in range(12)]
    for i in range(15):
        near = base.split()
        near[rng.randrange(60)] = f"edit{i}"
        rows.append((50 + i, " ".join(near)))
    rows += [(70, base), (71, base), (72, base.upper()), (73, None), (74, ""), (75, " \t\n"), (76, "one two")]
    rows += [(77, "one two"), (None, base), (78, ("again " * 70).strip()), (70, base)]
    return rows
