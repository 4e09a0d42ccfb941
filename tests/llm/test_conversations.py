import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest

from refrain.llm import conversations as conv

SIGNS = "suaxSUAX-"
GRAMMAR = re.compile(r"(s?(ua)+)?")


def shortest(signs):
    """Least (cost, audit), by Dijkstra over rows read and the last role."""
    step = {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}
    open_, done = [(0, "", 0, "")], set()
    while open_:
        cost, audit, i, last = heapq.heappop(open_)
        if i == len(signs) and last in ("", "a"):
            return cost, audit
        if (i, last) in done:
            continue
        done.add((i, last))
        for char in "ua":
            if (last, char) in step:
                heapq.heappush(open_, (cost + 5, audit + "I", i, char))
        if i < len(signs):
            sign = signs[i]
            heapq.heappush(open_, (cost + 2, audit + "D", i + 1, last))
            stays = 5 if sign.isupper() else 0
            for char in "sua" if sign != "-" else "":
                if (last, char) not in step:
                    continue
                if sign.lower() == char:
                    heapq.heappush(open_, (cost + stays, audit + "K", i + 1, char))
                elif char != "s":
                    heapq.heappush(open_, (cost + stays + 1, audit + "R", i + 1, char))


def exhaustive(signs):
    """Least (cost, audit) over all edits with up to two inserts in each gap."""
    inserts = ["", "u", "a", "ua", "au"]
    best = None
    ops = [["D"] + ([] if s == "-" else ["K", "Ru", "Ra"]) for s in signs]
    for gaps in itertools.product(inserts, repeat=len(signs) + 1):
        for chosen in itertools.product(*ops):
            roles, audit, cost = "", "", 0
            for i, gap in enumerate(gaps):
                roles, audit, cost = roles + gap, audit + "I" * len(gap), cost + 5 * len(gap)
                if i == len(signs):
                    continue
                op, sign = chosen[i], signs[i]
                audit += op[0]
                cost += {"D": 2, "K": 0, "R": 1}[op[0]]
                if op != "D":
                    cost += 5 * sign.isupper()
                    roles += sign.lower() if op == "K" else op[1]
            if GRAMMAR.fullmatch(roles) and (best is None or (cost, audit) < best):
                best = cost, audit
    return best


def spoken(signs):
    """Turns that are read as ``signs``."""
    roles = {"s": "system", "u": "user", "a": "assistant", "x": "tool"}
    for i, sign in enumerate(signs):
        text = " \n" if sign == "-" else f"turn {i}" + ("" if sign.isupper() else ".")
        yield i, roles.get(sign.lower(), "user"), text


def edited(signs):
    run = conv.Conversation()
    for turn, role, text in spoken(signs):
        run.add(turn, role, text, False)
    return run.result()[5:7]


def test_short_conversations_match_all_edits():
    for n in range(4):
        for signs in itertools.product("suaxU-" if n == 3 else SIGNS, repeat=n):
            assert edited("".join(signs)) == exhaustive("".join(signs)) == shortest("".join(signs))


@pytest.mark.parametrize("block", [1, 3, 32])
def test_blocks_give_the_same_audit(monkeypatch, block):
    monkeypatch.setattr(conv, "BLOCK", block)
    rng = random.Random(block)
    for _ in range(250):
        signs = "".join(rng.choice(SIGNS + "uauaua") for _ in range(rng.randint(0, 45)))
        assert edited(signs) == shortest(signs), signs


def test_a_very_long_conversation():
    rng = random.Random(1)
    signs = "".join(rng.choice(SIGNS + "ua" * 8) for _ in range(20_000))
    cost, audit = edited(signs)
    assert len(audit.replace("I", "")) == 20_000
    assert cost == shortest(signs)[0]


# -- whole tables --


def plain_repair(rows, damage):
    """Result for each conv_id, by the contract."""
    groups = {}
    for conv_id, turn, role, text in rows:
        mine = groups.setdefault(conv_id, [])
        key = ":".join(" " if x is None else str(x) for x in (conv_id, turn))
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(key.encode()) % 20 if damage else 9
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        mine += [(turn is not None, turn or 0, role, text)] * (1 + (kind == 3))
    out = []
    for conv_id, mine in groups.items():
        mine.sort(key=lambda r: (r[0], r[1], r[2].encode(), r[3].encode()))
        turns = [t for known, t, _, _ in mine if known]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        seen, signs, faults = set(), "", {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, _, role, text in mine:
            ink = re.findall(r"[^\x20\x09-\x0D]", text)
            sign = role[:1] if role[:1] in ("s", "u", "a") else "x"
            if not ink:
                faults["blank"] += 1
                sign = "-"
            elif (role, text) in seen:
                faults["duplicate"] += 1
                sign = "-"
            elif ink[-1] not in ".!?":
                faults["truncated"] += 1
                sign = sign.upper()
            seen.add((role, text))
            signs += sign
        initials = [r[2][:1] for r in mine]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit = shortest(signs)
        lines, last, left = [], "", iter(mine)
        for edit in audit:
            role, text = next(left)[2:] if edit != "I" else (None, "")
            if edit == "D":
                continue
            if edit != "K":
                role = "assistant" if last == "u" else "user"
            last = role[0]
            lines.append(f"{role}:{text}")
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv_id, gaps, *faults.values(), illegal, cost, audit, digest))
    return sorted(out, key=repr)


def talk(seed=2):
    rng = random.Random(seed)
    rows = []
    for c in range(150):
        role = rng.choice(["system", "user"])
        for t in range(rng.randint(0, 12) if c else 300):
            text = rng.choice(["Hello.", "Yes!", "é?", "cut of", "", " \t", None, f"line {t}.\n"])
            rows.append((c, t * rng.choice([1, 1, 2]), role, text))
            role = rng.choice(["user", "assistant", "assistant", "tool", "", None, "System"])
    rows += [(7, None, "user", "early."), (None, 1, "user", "Hi."), (None, None, "assistant", "Ho.")]
    rows += [(900, 4, "user", "Same.")] * 40 + [(901, None, None, None)]
    rng.shuffle(rows)
    return rows


def as_table(spark, rows, partitions=4):
    schema = "conv_id bigint, turn bigint, role string, text string, nth string, dropped string, said string, copy int"
    return spark.createDataFrame([(*r, "x", "y", "z", 5) for r in rows], schema).repartition(partitions)


@pytest.mark.parametrize("damage", [False, True])
def test_repair_matches_the_contract(spark, damage):
    rows = talk()
    got = conv.repair(as_table(spark, rows), damage).drop("system_first").collect()
    assert sorted(map(tuple, got), key=repr) == plain_repair(rows, damage)


def test_a_conversation_that_is_dropped_whole(spark):
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    got = conv.repair(as_table(spark, [(dropped, 1, "user", "Gone.")]), True).collect()
    nothing = hashlib.sha256(b"").hexdigest()
    assert [tuple(r) for r in got] == [(dropped, 0, 0, 0, 0, 0, 0, "", nothing, False)]


def test_repaired_turns_have_the_digest(spark):
    table = as_table(spark, talk(3))
    said = {}
    for r in sorted(conv.repaired_turns(table, True).collect(), key=lambda r: r.place):
        said.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
        assert r.place == len(said[r.conv_id])
    for r in conv.repair(table, True).collect():
        text = "\n".join(said.get(r.conv_id, []))
        assert hashlib.sha256(text.encode()).hexdigest() == r.repaired_sha256


def test_empty_table(spark):
    assert conv.repair(as_table(spark, [], 1), True).collect() == []
    assert conv.repaired_turns(as_table(spark, [], 1)).collect() == []
