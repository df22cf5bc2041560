"""Repair of conversations against an exhaustive search, on planted, random and edge rows."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from tapeloom.llm import conversations
from tapeloom.llm.conversations import ENDS, block_matrix, least_paths

from .conftest import CLASHES, SF

SPACE = " \t\n\x0b\f\r"
SCHEMA = "conv_id long, turn long, role string, text string"
LEGAL = re.compile(r"(s?(ua)+)?\Z")


def cheapest(rows):
    """(cost, audit, repaired) of [(role, text, fault)], by search over all edits with the automaton as a pattern."""
    @lru_cache(None)
    def best(i, state, inserts):  # least (cost, audit, roles and texts) from here
        found = []
        if i == len(rows) and state in ("", "a"):
            found.append((0, "", ()))
        follow = {"": "us", "s": "u", "u": "a", "a": "u"}[state]

        def go(cost, letter, role, text, i, inserts):
            rest = best(i, role[0] if role else state, inserts)
            if rest:
                found.append((cost + rest[0], letter + rest[1], (((role, text),) if role else ()) + rest[2]))

        names = {"u": "user", "a": "assistant"}
        if i < len(rows):
            role, text, fault = rows[i]
            more = 5 if fault == "truncated" else 0
            if fault not in ("blank", "duplicate"):
                if role and role[0] in follow:
                    go(more, "K", role, text, i + 1, 0)
                for f in follow:
                    if f in names:
                        go(1 + more, "R", names[f], text, i + 1, 0)
            go(2, "D", None, None, i + 1, 0)
        if inserts < 3:
            for f in follow:
                if f in names:
                    go(5, "I", names[f], "", i, inserts + 1)
        return min(found, default=None, key=lambda x: x[:2])

    return best(0, "", 0)


def want(table):
    """The contract, conversation by conversation, on [(conv_id, turn, role, text)]."""
    out = {}
    for key in {r[0] for r in table}:
        rows = []
        for c, turn, role, text in table:
            if c != key:
                continue
            roll = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
            role, text = " " if role is None else role, " " if text is None else text
            if roll == 0:
                continue
            text = "" if roll == 1 else re.sub("[.!?]", "", text) if roll == 2 else text
            role = "user" if roll == 4 else role
            rows += [(turn, role, text)] * (2 if roll == 3 else 1)
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).hexdigest()))
        seen, marked, count = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for _, role, text in rows:
            bare = text.strip(SPACE)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                count[fault] += 1
            marked.append((role, text, fault))
        turns = [t for t, _, _ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        initials = [r[:1] for _, r, _ in rows]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, left = cheapest(tuple(marked))
        assert LEGAL.match("".join(r[0] for r, _ in left))
        text = "\n".join(f"{r}:{t}" for r, t in left)
        out[key] = (gaps, *count.values(), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


def got(df, **more):
    rows = conversations.repair(df, **more).collect()
    assert len({r["conv_id"] for r in rows}) == len(rows)
    return {r["conv_id"]: tuple(r)[1:] for r in rows}


def random_rows(seed, conversations=40, most=14):
    r = random.Random(seed)
    texts = ["Yes.", "No!", "well", " ", "", "Why?  ", "so it goes \n", "a." * 3, None]
    roles = ["user", "assistant", "system", "tool", "", "usher", None]
    table = []
    for c in range(conversations):
        for t in range(r.randrange(1, most)):
            table.append((c, r.choice([t, t, t, t + 3, None]), r.choice(roles[:3] * 4 + roles), r.choice(texts[:2] * 3 + texts)))
    return table


@pytest.mark.parametrize("block", [3, 1024])
def test_random_conversations(spark, block):
    table = random_rows(block) + [(100, t, ("user", "assistant")[t % 2], f"line {t}.") for t in range(200)]
    assert got(spark.createDataFrame(table, SCHEMA), block=block) == want(table)


def test_given_conversations(spark):
    df = spark.read.parquet(f"{SF}/conversations.parquet")
    table = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert got(df) == want(table)


def test_edges(spark):
    table = [
        (None, None, None, None), (None, 0, "user", "Hello."), (None, 0, "user", "Hello."), (None, 1, "assistant", "Yes."),
        (1, None, "user", "a."), (1, None, "assistant", "b."), (2, 5, "assistant", "only."), (3, 0, "", ""), (3, -4, "s", "x.  \t"),
        (4, 0, "user", "long " * 200_000 + "end."), (4, 1, "assistant", "é" * 10_000), (5, 9, "user", "naïve “quotes” 日本語!"),
        (6, 3, "user", "\x00 control?"), (6, 3, "assistant", "same turn."), (6, 3, "assistant", "same turn, other text."),
    ]
    table += [(7, 7, "user", "hot")] * 300  # one row many times
    df = spark.createDataFrame(table, SCHEMA).select("*", *[F.lit("clash").alias(c) for c in CLASHES])
    df = df.select("*", *[F.lit(1).alias(c) for c in ("b", "pos", "codes", "audit", "kind", "turns", "_c", "again", "first")])
    assert got(df) == want(table)
    assert got(df, block=4) == want(table)
    assert conversations.repair(df.limit(0)).collect() == []


def test_conversation_without_rows_left(spark):
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(dropped, 0, "user", "gone.")], SCHEMA)
    assert got(df) == {dropped: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_blocks_compose():
    """Matrices of parts multiply to that of the whole, and paths through parts join to the least path."""
    r = np.random.default_rng(5)
    for _ in range(30):
        rows = r.integers(0, 16, (1, 24))
        one = np.array([24])
        whole = block_matrix(rows, one)[0]
        halves = [block_matrix(rows[:, i:i + 12], np.array([12]))[0] for i in (0, 12)]
        product = (halves[0][:, :, None] + halves[1][None]).min(1)
        assert (np.minimum(product, 1 << 49) == np.minimum(whole, 1 << 49)).all()
        end = np.array([ENDS])
        cost, _, audit = least_paths(rows, one, end, np.array([True]))
        after = (halves[1] + np.array(ENDS)).min(1)[None]
        cost1, exits, first = least_paths(rows[:, :12], np.array([12]), after, np.array([False]))
        _, _, second = least_paths(rows[:, 12:], np.array([12]), end, np.array([True]))
        assert cost[0].tolist() == cost1[0].tolist()
        for s in range(4):
            assert audit[0][s] == first[0][s] + second[0][exits[0][s]]


def test_repaired_rows_are_legal(spark):
    df = spark.createDataFrame(random_rows(9), SCHEMA)
    rows = conversations.damage(df)
    left = conversations.repaired(rows, conversations.plan(rows)).collect()
    by = {}
    for r in sorted(left, key=lambda r: (r["conv_id"], r["place"])):
        by.setdefault(r["conv_id"], []).append(r["role"][0])
    assert by and all(LEGAL.match("".join(x)) for x in by.values())
