"""Conversation repair against a plain dynamic program over all edits, whole conversations and cut ones."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import types as T

from sedgemill.llm import conversations as cv

SCHEMA = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
    T.StructField("text", T.StringType()), T.StructField("block", T.IntegerType()), T.StructField("copies", T.StringType()),
])
NEXT = {"": "su", "s": "u", "u": "a", "a": "u"}
NAMES = {"u": "user", "a": "assistant"}


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        say = lambda x: " " if x is None else str(x)
        fate, role, text = zlib.crc32(f"{say(conv)}:{say(turn)}".encode()) % 20, say(role), say(text)
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        out += [(conv, turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    return out


def plain_repair(rows):
    """Faults, cost, audit and repaired text of one conversation, by a table over (row, last role) from the back."""
    low = lambda x: (x is not None, x or 0)
    rows = [(c, t, *(" " if x is None else x for x in said)) for c, t, *said in rows]
    rows = sorted(rows, key=lambda r: (low(r[1]), r[2], r[3]))
    seen, faults = set(), []
    for _, _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    best = {(len(rows), q): v for q, v in {"": (0, "", ()), "s": (6, "II", ("u", "a")), "u": (3, "I", ("a",)), "a": (0, "", ())}.items()}
    add = lambda cost, letter, put, rest: (cost + rest[0], letter + rest[1], (put, *rest[2]))
    for i in range(len(rows) - 1, -1, -1):
        _, _, role, text = rows[i]
        more = 3 * (faults[i] == "truncated")
        for q in NEXT:
            found = [add(4, "D", None, best[i + 1, q])]
            if faults[i] not in ("blank", "duplicate"):
                if role[:1] and role[:1] in NEXT[q]:
                    found.append(add(more, "K", (role, text), best[i + 1, role[0]]))
                to = "a" if q == "u" else "u"
                found.append(add(3 + more, "R", (NAMES[to], text), best[i + 1, to]))
            best[i, q] = min(found, key=lambda x: x[:2])
        for _ in range(3):
            for q in NEXT:
                to = "a" if q == "u" else "u"
                best[i, q] = min(best[i, q], add(3, "I", to, best[i, to]), key=lambda x: x[:2])
    cost, audit, put = best[0, ""] if rows else (0, "", ())
    text = "\n".join(f"{NAMES[p]}:" if isinstance(p, str) else f"{p[0]}:{p[1]}" for p in put if p is not None)
    turns = [r[1] for r in rows if r[1] is not None]
    pairs = [a[2][:1] + b[2][:1] for a, b in zip(rows, rows[1:], strict=False)]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256(text.encode()).hexdigest())


@pytest.fixture(scope="module")
def talks():
    rnd = random.Random(3)
    says = ["Yes.", "No", "Well?", "  ", "", "Go on.\n", "a.b", "...", "x" * 5000, "é!"]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None]
    rows = []
    for conv in range(80):
        for turn in range(rnd.randint(1, 12)):
            role = "system" if turn == 0 and conv % 3 == 0 else roles[(turn + conv) % 2] if rnd.random() < 0.7 else rnd.choice(roles)
            text = f"t{turn} {conv}." if rnd.random() < 0.6 else rnd.choice(says)
            rows.append((conv, turn if rnd.random() < 0.95 else None, role, text if rnd.random() < 0.97 else None))
    rows += [(200, t, "user", "same.") for t in range(30)] + [(201, 4, "user", "again.")] * 40 + [(None, 1, "user", "a."), (None, None, None, None)]
    rows += [(300, t, rnd.choice(roles[:5]), rnd.choice(["ok.", "cut", f"{t}.", ""])) for t in range(400)]
    rows += [(400, None, "user", "a."), (400, None, "assistant", "b"), (500, 7, None, None), (501, 1, "system", "only me.")]
    return rows


def _table(spark, rows):
    return spark.createDataFrame([(*r, 7, "x") for r in rows], SCHEMA).repartition(5)


def _want(rows, named=()):
    by = {n: [] for n in named}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    return sorted(((conv, *plain_repair(own)) for conv, own in by.items()), key=str)


def test_repair_is_the_cheapest_and_the_least(spark, talks):
    got = cv.repair(_table(spark, talks)).collect()
    assert sorted(map(tuple, got), key=str) == _want(talks)


def test_long_conversations_are_composed(spark, talks, monkeypatch):
    monkeypatch.setattr(cv, "BLOCK", 7)
    monkeypatch.setattr(cv, "LAYERS", 3)
    got = cv.repair(_table(spark, talks)).collect()
    assert sorted(map(tuple, got), key=str) == _want(talks)


def test_damage_and_conversations_without_rows(spark, talks):
    rows = talks + [(1000 + i, 0, "user", "one.") for i in range(60)]
    table = _table(spark, rows)
    got = sorted(map(tuple, cv.repair(cv.damaged(table), table).collect()), key=str)
    assert got == _want(plain_damage(rows), {r[0] for r in rows})
    assert any(r[-2] == "" and r[-1] == hashlib.sha256(b"").hexdigest() for r in got)
    assert cv.repair(cv.damaged(table.limit(0)), table.limit(0)).collect() == []


def test_prices_are_distances_and_stay_feasible():
    rnd = random.Random(9)
    for _ in range(200):
        steps = tuple(cv.steps_of(rnd.choice("suat"), rnd.random() < 0.1, rnd.random() < 0.3, rnd.random() < 0.9, rnd.choice([1, 1, 3]))[0]
                      for _ in range(rnd.randint(1, 9)))
        arcs = cv.lattice(steps, cv.AT_END)
        price = [0] * len(arcs)
        cv.settle(arcs, price, 0)
        assert all(price[i] <= cost + price[j] for i, out in enumerate(arcs) if out for _, cost, j in out)
        far = [0 if i == len(arcs) - 1 else cv.FAR for i in range(len(arcs))]
        for _ in arcs:
            for i in range(len(arcs) - 1):
                far[i] = min([far[i], *(cost + far[j] for _, cost, j in arcs[i])])
        assert price[0] == far[0]
