"""The trie of conversations against one built turn by turn."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from lexmill.llm import prefix_trie as pt

SCHEMA = "conv_id long, turn long, role string, text string, Depth int, node string, x string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def slow_trie(rows):
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(x)] for c, x in turns.items()}
    made = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5 if c > 0 else -(abs(c) % 5))
        made[c] = (*turns.get(base, [])[:h], *own[h:])
    members = {}
    for c, x in made.items():
        for d in range(len(x) + 1):
            members.setdefault(x[:d], []).append(c)
    out = []
    for top, who in members.items():
        below = [x for x in members if x[: len(top)] == top]
        children = {x for x in below if len(x) == len(top) + 1}
        leaves = sum(not any(len(y) == len(x) + 1 and y[: len(x)] == x for y in below) for x in below)
        saved = sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in below if x)
        ends = ",".join(map(str, sorted(c for c in who if made[c] == top)))
        out.append((min(who), len(top), min(members[top[:-1]]) if top else None, len(who), len(children), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def check(spark, rows, **options):
    df = spark.createDataFrame([(*r, 1, "n", "x") for r in rows], SCHEMA).repartition(3)
    found = pt.prefix_trie(df, **options)
    assert found.columns == COLUMNS
    got = sorted(map(tuple, found.collect()), key=str)
    assert got == slow_trie(rows)
    return got


def conversations(rnd, n, longest=6):
    rows = []
    for c in range(n):
        for t in range(rnd.randrange(1, longest)):
            rows.append((c, t, rnd.choice(["user", "assistant", None]), rnd.choice(["é", "b", None, "long text"])))
    return rows


@pytest.mark.parametrize("shard_turns", [200_000, 3, 0])
def test_trie(spark, shard_turns):
    rnd = random.Random(2)
    rows = conversations(rnd, 60)
    rows += [(c, t, "user", f"copy {t}") for c in range(100, 130) for t in range(12)]  # copies
    rows += [(c, t, "user", f"copy {t}") for c in range(130, 150) for t in range(c % 15)]  # prefixes of them
    rows += [(200, t, "user", "x") for t in range(40)] + [(205, t, "user", "x") for t in range(41)]  # long ones
    rows += [(-3, 0, "user", "n"), (-5, 0, "user", "n"), (-5, 1, "user", "m"), (None, 0, "user", "n"), (300, None, "user", "first"), (300, 0, "user", "then"), (7, 5, "user", "again"), (7, 5, "user", "again")]
    check(spark, rows, shard_turns=shard_turns)


def test_few(spark):
    assert check(spark, []) == []
    assert len(check(spark, [(3, 0, "user", None)])) >= 1
    check(spark, [(0, 0, "a", "b"), (5, 0, "a", "b"), (10, 0, "a", "b")])
    assert check(spark, [(None, 1, "a", "b")]) == []


def test_ties_have_one_order(spark):
    rows = [(4, 1, "r", f"t{i % 7}") for i in range(30)]
    one, other = (pt.prefix_trie(spark.createDataFrame(x, "conv_id long, turn long, role string, text string").repartition(n)).collect() for x, n in ((rows, 2), (rows[::-1], 5)))
    assert sorted(one) == sorted(other)


def test_turnless_conversations(spark):
    # all of a conversation's turns are replaced, and its group's first one is absent
    found = [c for c in range(6, 400) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 2][:5]
    got = check(spark, [(c, 0, "r", "t") for c in found])
    assert got[0][:6] == (min(found), 0, None, 5, 0, 1) and len(got) == 1


def test_louds():
    sizes, paths = np.array([2, 3, 1, 0]), np.array([5, 7, 5, 7, 9, 8])
    trie, node_of, last = pt.grow(5, sizes, paths)
    assert trie.labels.tolist() == [5, 5, 8, 7, 9] and trie.bits.astype(int).tolist() == [1, 1, 0, 1, 0, 0, 1, 0, 0]
    assert trie.parents().tolist() == [0, 0, 1, 3] and last.tolist() == [3, 4, 2, 0] and node_of.tolist() == [1, 3, 1, 3, 4, 2]
    value = np.array([1, 10, 100, 1000, 10000])
    trie.roll_up(value)
    assert value.tolist() == [11111, 11010, 100, 11000, 10000]
