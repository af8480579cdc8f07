"""Mixtures against plain water filling and plain entropy balancing."""

import inspect
import math
import random
import re

import pytest

from lexmill.llm import mixing
from lexmill.llm.mixing import mix

SCHEMA = "doc_id long, text string, source string, SIZE int, key string, target int, taken string"


def slow_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """``sizes`` by source; the excess of full sources is dealt out again until there is none."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    budget, full = share * sum(sizes.values()), set()
    while True:
        rest, open_ = budget - sum(most * sizes[s] for s in full), sum(weight[s] for s in order if s not in full)
        target = {s: most * sizes[s] if s in full else rest * weight[s] / open_ for s in order}
        more = {s for s in order if target[s] > most * sizes[s]}
        if not more - full:
            return target
        full |= more


def slow_rates(sizes, target, most=2):
    """Rates by size that give a source its target, by bisection of the tilt."""
    if target >= most * sum(sizes):
        return {s: float(most) for s in sizes}
    rate = lambda tilt, s: most if tilt * s > math.log(most) else math.exp(tilt * s)
    low, high = -1.0, 1.0
    while sum(s * rate(low, s) for s in sizes) > target:
        low *= 2
    while sum(s * rate(high, s) for s in sizes) < target:
        high *= 2
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if sum(s * rate(middle, s) for s in sizes) < target else (low, middle)
    return {s: rate(low, s) for s in sizes}


def check(spark, rows, parts=3):
    df = spark.createDataFrame([(*r, 1, "k", 2, "t") for r in rows], SCHEMA).repartition(parts)
    found = mix(df)
    assert found.columns == ["doc_id", "size", "source_size", "target", "taken"]
    assert dict(found.dtypes) == {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"}
    found = sorted(map(tuple, found.collect()), key=str)
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    by_source, ids = {}, {}
    for i, t, s in rows:
        by_source.setdefault(s, []).append(words(t))
        ids.setdefault((i, words(t)), set()).add(s)
    targets = slow_targets({s: sum(x) for s, x in by_source.items()})
    assert sorted(((i, n) for i, n, *_ in found), key=str) == sorted(((i, words(t)) for i, t, _ in rows), key=str)
    for s, sizes in by_source.items():
        mine = [r for r in found if ids[r[0], r[1]] == {s}]
        rates, whole = slow_rates(sizes, targets[s]), 0
        assert all(r[2] == sum(sizes) and r[3] == pytest.approx(targets[s]) for r in mine)
        for _, n, _, _, taken in mine:
            assert 0 <= taken <= 2 * n
            whole += not n or taken in {n * math.floor(rates[n]), n * math.floor(rates[n] + 1), n * math.floor(rates[n] + 1e-6)}
        if len(mine) == len(sizes):
            assert abs(sum(r[4] for r in mine) - targets[s]) <= len(mine) - whole + 0.5
            assert len({r[0] for r in mine}) - whole <= 1  # one document is cut at most
    return found


def text(rnd, n):
    return "".join(rnd.choice(["wörd", "a", " b", "-"]) + rnd.choice([" ", "\n", "\t ", "\x0b"]) for _ in range(n))


def test_mixture(spark):
    rnd = random.Random(5)
    rows = [(i, text(rnd, rnd.choice([1, 3, 10, 40, 200])), rnd.choice(["a", "a", "a", "b", "B", "é", "\U0001f600", None])) for i in range(400)]
    rows += [(1000, text(rnd, 9000), "long"), (1001, None, "a"), (1002, "", "a"), (1003, " \n", "empty"), (1004, None, None), (None, "x y", "b"), (1005, "one", "tiny"), (1006, "one two", "￿")]
    first = check(spark, rows)
    assert check(spark, rows[::-1], parts=7) == first


def test_repeated_rows(spark):
    rows = [(7, "the same words again and again", "a")] * 300 + [(i, "w " * (i % 50), "b" if i % 5 else "a") for i in range(100, 160)]
    found = check(spark, rows)
    assert len([r for r in found if r[0] == 7]) == 300


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(1, "a b c", "s")], [(1, "a", "s"), (2, "", "t")]])
def test_few_rows(spark, rows):
    check(spark, rows, parts=1)


def test_native():
    source = inspect.getsource(mixing)
    assert not re.search(r"udf|mapIn|applyIn|rdd|pandas|arrow|collect\(\)", source, re.IGNORECASE)
