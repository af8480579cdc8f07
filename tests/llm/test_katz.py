"""Katz backoff against a plain implementation, and its normalisation."""

import functools
import math
import os
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from lexmill.llm import katz
from lexmill.llm.queries import op5_lm_scoring


def tokens_of(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\r\x0b\x0c":
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w] + ["\n"]


def factors(counts):
    n = Counter(counts)
    k = katz.DISCOUNTED
    if all(n[r] for r in range(1, k + 2)) and (k + 1) * n[k + 1] < n[1]:
        a = (k + 1) * n[k + 1] / n[1]
        f = [((r + 1) * n[r + 1] / (r * n[r]) - a) / (1 - a) for r in range(1, k + 1)]
        if all(0 < x < 1 for x in f):
            return lambda c: c * (f[c - 1] if c <= k else 1)
    return lambda c: c * ((c - 0.5) / c if c <= k else 1)


class Plain:
    """The model with dictionaries: n-grams are tuples, a text is preceded by enough start marks."""

    def __init__(self, texts, order):
        self.order = order
        seqs = [tokens_of(t) for t in texts]
        self.counts = [Counter(tuple(p[i - k : i + 1]) for s in seqs for p in [["\t"] * k + s] for i in range(k, len(p))) for k in range(order)]
        self.uni = {w: c for (w,), c in self.counts[0].items()}
        self.n, self.v = sum(self.uni.values()), len(self.uni)
        self.d = [factors(c.values()) for c in self.counts]
        left = self.n - sum(self.d[0](c) for c in self.uni.values())
        self.norm, self.left = (self.n, left) if left > 1e-9 else (self.n + 1, 1.0)
        self.followers = [defaultdict(list) for _ in range(order)]
        for k in range(order):
            for g in self.counts[k]:
                self.followers[k][g[:-1]].append(g)

    def p(self, context, w):
        k = len(context)
        if not k:
            return (self.d[0](self.uni[w]) if w in self.uni else self.left) / self.norm
        known = self.followers[k][context]
        if not known:
            return self.p(context[1:], w)
        n = sum(self.counts[k][g] for g in known)
        kept = sum(self.d[k](self.counts[k][g]) for g in known)
        n = n if kept < n - 1e-9 else n + 1
        if (*context, w) in self.counts[k]:
            return self.d[k](self.counts[k][*context, w]) / n
        return (1 - kept / n) / (1 - sum(self.p(context[1:], g[-1]) for g in known)) * self.p(context[1:], w)


def check(rows, texts, held, order):
    model = Plain([t for i, t in texts if not held(i)], order)
    model.p = functools.lru_cache(maxsize=None)(model.p)
    want = []
    for i, t in texts:
        s = tokens_of(t)
        base = sum(math.log10((model.uni.get(w, 0) + 1) / (model.n + model.v + 1)) for w in s)
        padded = ["\t"] * (order - 1) + s
        score = sum(math.log10(model.p(tuple(padded[x : x + order - 1]), w)) for x, w in enumerate(s))
        want.append((i, held(i), len(s), sum(w in model.uni for w in s), model.n, base, score))
    rows, want = sorted(map(tuple, rows)), sorted(want)
    assert [r[:5] for r in rows] == [w[:5] for w in want]
    assert [r[5:] for r in rows] == [pytest.approx(w[5:], rel=1e-9) for w in want]
    return model


def held_out(i):
    return zlib.crc32(str(i).encode()) % 7 == 2


@pytest.mark.parametrize("order", [1, 2, 3, 4])
@pytest.mark.parametrize(("words", "parts"), [(12, {}), (3000, {"words_each": 50, "grams_each": 70, "spread": 20})])
def test_odd_texts(spark, words, parts, order):
    rnd = random.Random(words)
    texts = [(0, None), (1, ""), (2, "A b\tÉ  a"), (3, "only-here"), (3, "only-here")]
    texts += [(i, " ".join("w%d" % min(rnd.randrange(1, words), rnd.randrange(1, words)) for _ in range(rnd.randrange(60)))) for i in range(4, 300)]
    df = spark.createDataFrame([(*r, "c") for r in texts], "doc_id long, text string, score string")
    got = katz.score(df.repartition(3), F.crc32(F.col("doc_id").cast("string")) % 7 == 2, order=order, **parts).collect()
    model = check(got, texts, held_out, order)
    for k in range(1, order):
        for h in [*list(model.followers[k])[:10], ("\t",) * k]:
            assert sum(model.p(h, w) for w in model.uni) + model.p(h, "\0never") == pytest.approx(1)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_texts_larger_than_a_block(spark, monkeypatch, order):
    rnd = random.Random(order)
    monkeypatch.setattr(katz, "BLOCK_BYTES", 40)
    words = lambda n: " ".join("w%d" % min(rnd.randrange(9), rnd.randrange(9)) for _ in range(n))
    texts = [(i, words(rnd.choice([2, 10, 60]))) for i in range(40)] + [(50, " " * 200), (51, "x" * 300), (52, " " * 90 + words(30) + "\n" * 90 + words(9) + " " * 90), (7, words(80))]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    held = lambda i: i % 5 == 2
    assert max(len(list(katz.pieces((t or "").encode(), order - 1, 40))) for _, t in texts) > 3
    check(katz.score(df.coalesce(1), F.col("doc_id") % 5 == 2, order=order).collect(), texts, held, order)


def test_kept_tables_are_the_model(spark, tmp_path):
    rnd = random.Random(6)
    texts = [(i, " ".join("w%d" % min(rnd.randrange(30), rnd.randrange(30)) for _ in range(rnd.randrange(40)))) for i in range(200)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    check(katz.score(df, F.lit(False), keep=f"{tmp_path}/model", grams_each=900, spread=100).collect(), texts, lambda i: False, 3)
    model = Plain([t for _, t in texts], 3)
    words = {r.word: r for r in katz.table(spark, f"{tmp_path}/model", 1).collect()}
    names = {katz.xxhash.xxh64_intdigest(w.encode(), katz.SEED): w for w in model.uni}
    name = {n: names[r.hash & (1 << 64) - 1] for n, r in words.items()}
    assert {name[n]: (r["count"], round(r.p, 12)) for n, r in words.items()} == {w: (c, round(model.p((), w), 12)) for w, c in model.uni.items()}
    gram = {katz.START: ("\t",)} | {n: (w,) for n, w in name.items()}
    for order in (2, 3):
        rows = katz.table(spark, f"{tmp_path}/model", order).collect()
        start = {katz.START: ("\t",) * (order - 1)}
        got = {(*(gram | start)[r.context], name[r.word]): r for r in rows}
        assert {g: r["count"] for g, r in got.items()} == model.counts[order - 1]
        for g, r in list(got.items())[:200]:
            assert r.p == pytest.approx(model.p(g[:-1], g[-1]))
            assert r.alpha == pytest.approx(model.p(g[:-1], "\0never") / model.p(g[1:-1], "\0never"))
        gram = {r.number: g for g, r in got.items()}


def test_work_files_are_removed(spark):
    from lexmill.storage import shared_dir

    folder = shared_dir(spark).removeprefix("file://")
    before = set(os.listdir(folder))
    df = spark.createDataFrame([(1, "a b a b"), (2, "a c")], "doc_id long, text string")
    assert katz.score(df, F.lit(False)).count() == 2
    assert [x.split("-")[0] for x in set(os.listdir(folder)) - before] == ["scores"]


def test_no_training_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert sorted((r.doc_id, r.n_tokens, r.train_tokens, r.score, r.base_score) for r in katz.score(df, F.lit(True)).collect()) == [(1, 3, 0, 0.0, 0.0), (2, 1, 0, 0.0, 0.0)]
    assert katz.score(df.limit(0), F.lit(True)).collect() == []


def test_table(spark):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    check(op5_lm_scoring(spark, "/root/testdata/sf0.001").collect(), texts, held_out, katz.ORDER)
