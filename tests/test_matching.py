"""Greedy matching and token search against plain loops."""

import random
import uuid

import pandas as pd
import pytest
from pyspark.sql import functions as F

from lexmill.operators import captions, reconcile, tokens
from lexmill.operators.tokens import rare_tokens, token_shares


def slow_greedy(pairs):
    keys, records, taken = set(), set(), []
    for score, key, record in sorted(pairs, key=lambda p: (-p[0], p[1], p[2])):
        if key not in keys and record not in records:
            keys.add(key)
            records.add(record)
            taken.append((*key, record))
    return sorted(taken)


@pytest.mark.parametrize("task_pairs, seed", [(0, 1), (0, 2), (40, 3), (10**6, 4)])
def test_one_to_one(spark, task_pairs, seed):
    rnd = random.Random(seed)
    pairs = {((v, o), r): rnd.choice([0.5, 0.75, 1.0, rnd.random()]) for v in (1, 2, 3) for o in range(12) for r in range(100 * v, 100 * v + 14) if rnd.random() < v / 3}
    rows = [(v, o, r, s) for ((v, o), r), s in pairs.items()]
    df = spark.createDataFrame(rows, "volume int, ord long, cluster_id long, score double")
    got = reconcile.one_to_one(df, ["volume"], ("score", False), ("ord", True), ("cluster_id", True), task_pairs=task_pairs)
    assert sorted(map(tuple, got.collect())) == slow_greedy([(s, k, r) for (k, r), s in pairs.items()])


def test_few_rounds_for_many_pairs(spark, caplog):
    df = spark.range(400).selectExpr("1 AS volume", "id AS ord").crossJoin(spark.range(400).selectExpr("id AS cluster_id")).selectExpr("*", "CAST(xxhash64(ord, cluster_id) AS double) AS score")
    with caplog.at_level("INFO", "lexmill.operators.reconcile"):
        got = reconcile.one_to_one(df, ["volume"], ("score", False), task_pairs=20_000)
        assert got.count() == 400
    assert 1 <= int(caplog.messages[-1].split()[0]) <= 6


def test_token_shares(spark):
    rnd = random.Random(1)
    words = [f"w{int(rnd.paretovariate(0.6)) % 60}" for _ in range(400)]
    queries = {i: sorted(set(rnd.sample(words, rnd.randrange(1, 12)))) for i in range(30)} | {98: [], 99: ["absent", "gone"]}
    texts = {i: sorted(set(rnd.sample(words, rnd.randrange(0, 60)))) for i in range(80)} | {1000: []}
    q, t = spark.createDataFrame(list(queries.items()), "query long, wanted array<string>"), spark.createDataFrame(list(texts.items()), "text long, found array<string>")
    for least in (0.5, 0.34, 1.0):
        got = {(r.query, r.text): r.score for r in token_shares(q, t, least).collect()}
        want = {(i, j): len(set(a) & set(b)) / len(a) for i, a in queries.items() for j, b in texts.items() if a and len(set(a) & set(b)) / len(a) >= least}
        assert got == want
    probes = rare_tokens(q, t.selectExpr("text", "explode(found) AS w"), 0.5).groupBy("query").count().collect()
    assert all(r["count"] <= len(queries[r["query"]]) // 2 + 1 for r in probes)


@pytest.mark.parametrize("by_key, task_looks, seed", [(False, 10**6, 1), (True, 10**6, 2), (False, 3, 3), (True, 3, 4), (False, 10**6, 5), (True, 10**6, 6)])
def test_one_to_one_of_looks(spark, by_key, task_looks, seed):
    rnd = random.Random(seed)
    keys, records, pairs = [], [], []
    for v in (1, 2, 3):
        ords, ids = rnd.sample(range(1000), 40), rnd.sample(range(1000 * v, 1000 * v + 1000), 40)
        a, b = [sorted(ords[i::7]) for i in range(7)], [sorted(ids[i::6]) for i in range(6)]
        keys += [(v, x[0], x) for x in a]
        records += [(v, x[0], x) for x in b]
        pairs += [(v, x[0], y[0], rnd.choice([0.5, 0.75, 1.0])) for x in a for y in b if rnd.random() < v / 3]
    frames = [spark.createDataFrame(rows, f"volume int, {names}") for rows, names in ((keys, "a long, members array<long>"), (records, "b long, members array<long>"), (pairs, "a long, b long, score double"))]
    got = reconcile.one_to_one_looks(*frames, ["volume"], by_key, task_looks=task_looks, task_pairs=40)
    members = {(v, x): m for v, x, m in keys}, {x: m for _, x, m in records}
    every = [(s, (v, k), r) for v, x, y, s in pairs for k in members[0][v, x] for r in members[1][y]]
    want = slow_greedy([(s, k, r) for s, k, r in every]) if not by_key else slow_greedy([(-k[1] * 10 + s, k, r) for s, k, r in every])
    assert sorted(map(tuple, got.collect())) == want


def test_copies_make_no_pairs(spark, monkeypatch):
    sizes = []
    looks = reconcile.one_to_one_looks
    monkeypatch.setattr(reconcile, "one_to_one_looks", lambda keys, records, pairs, *rest: sizes.append(pairs.count()) or looks(keys, records, pairs, *rest))
    key = spark.range(2000).selectExpr("3 AS us_volume", "IF(id < 1000, '7', '9') AS page", "'alpha beta' AS name", "id AS ord")
    kept = spark.range(1500).selectExpr("10000 + id AS cluster_id", "3 AS us_volume", "'7' AS us_page", "'alpha beta' AS case_name")
    got = reconcile.outcomes(key, kept)
    assert {(r.kind, r.page): r["count"] for r in got.groupBy("kind", "page").count().collect()} == {("matched_key", "7"): 1000, ("matched_key", "9"): 500, ("missing", "9"): 500, ("matched", "7"): 1500}
    assert sizes == [1, 1]


def test_volumes_of_copies(spark, monkeypatch):
    sizes = []
    looks = reconcile.one_to_one_looks
    monkeypatch.setattr(reconcile, "one_to_one_looks", lambda keys, records, pairs, *rest: sizes.append(pairs.count()) or looks(keys, records, pairs, *rest))
    key = spark.range(1200).selectExpr("CAST(id % 2 + 4 AS int) AS us_volume", "'1' AS page", "IF(id % 3 = 0, 'alpha beta', 'gamma delta') AS name", "id AS ord")
    kept = spark.range(1000).selectExpr("id AS cluster_id", "CAST(id % 2 + 4 AS int) AS us_volume", "'1' AS us_page", "'alpha beta' AS case_name")
    rows = {r.volume: tuple(r)[1:] for r in reconcile.reconcile(key, kept, 4, 6)[0].collect()}
    assert rows == {4: (500, 600, 200, 400, 300), 5: (500, 600, 200, 400, 300), 6: (0, 0, 0, 0, 0)}
    assert sizes[0] <= 4


def test_captions_of_many_pairs_are_compared_once(spark, monkeypatch, tmp_path):
    def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
        (tmp_path / uuid.uuid4().hex).write_text(str(len(a)))
        return (a.str.len() / b.str.len()).astype("float64")

    monkeypatch.setattr(captions, "sequence_ratio", F.pandas_udf(ratio, "double"))
    pairs = spark.range(3000).selectExpr("id", "concat('abc', id % 3) AS a", "concat('abcde', id % 2) AS b")
    got = captions.with_ratio(pairs, "a", "b", 0.5).where("ratio >= 0.5").groupBy("ratio").count().collect()
    assert [(r.ratio, r["count"]) for r in got] == [(4 / 6, 3000)]
    assert sum(int(f.read_text()) for f in tmp_path.iterdir()) == 6


def test_outcomes_compare_each_two_captions_once(spark, monkeypatch, tmp_path):
    def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
        (tmp_path / uuid.uuid4().hex).write_text(str(len(a)))
        return pd.Series([1.0 if x == y else 0.5 for x, y in zip(a, b, strict=True)])

    monkeypatch.setattr(captions, "sequence_ratio", F.pandas_udf(ratio, "double"))
    key = spark.range(400).selectExpr("CAST(id % 2 + 4 AS int) AS us_volume", "CAST(id % 20 AS string) AS page", "IF(id % 40 < 20, 'alpha beta', 'gamma delta') AS name", "id AS ord")
    kept = spark.range(400).selectExpr("id AS cluster_id", "CAST(id % 2 + 4 AS int) AS us_volume", "CAST(id % 20 AS string) AS us_page", "IF(id % 40 < 20, 'alpha beta', 'gamma omega') AS case_name")
    rows = {(r.kind, r.name): r["count"] for r in reconcile.outcomes(key, kept).groupBy("kind", "name").count().collect()}
    assert rows == {("matched_key", "alpha beta"): 200, ("matched_key", "gamma delta"): 200, ("matched", "alpha beta"): 200, ("matched", "gamma omega"): 200}
    assert sum(int(f.read_text()) for f in tmp_path.iterdir()) == 4


def test_token_shares_keep_wanted_tokens_alone(spark, monkeypatch):
    kept = {}
    stored = tokens.stored
    monkeypatch.setattr(tokens, "stored", lambda df, label: kept.setdefault(label, stored(df, label)))
    score = token_shares.__wrapped__(spark.createDataFrame([(1, ["a", "b", "c"]), (2, ["z", "gone"])], "query long, wanted array<string>"),
        spark.createDataFrame([(i, [*[f"w{j}" for j in range(200)], *("a", "z", "", "a", "b")[: i + 1]]) for i in range(5)] + [(9, None)], "text long, found array<string>"), 0.5)
    assert sorted(map(tuple, score.collect())) == [(1, 4, 2 / 3), (2, 1, 0.5), (2, 2, 0.5), (2, 3, 0.5), (2, 4, 0.5)]
    sizes = {r.text: len(r.found or []) for r in kept["texts"].collect()}
    assert sizes == {0: 1, 1: 2, 2: 2, 3: 2, 4: 3}
