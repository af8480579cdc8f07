"""Language identification: exact paths, spans, scripts and held-out accuracy."""

import bisect
import itertools
import math
import random
import unicodedata
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexmill.llm import langid
from lexmill.llm.langid import best_path, fit, identify
from lexmill.llm.queries import op4_language_id


def slow_path_value(scores, labels, penalty):
    return sum(scores[i, k] for i, k in enumerate(labels)) - penalty * sum(a != b for a, b in itertools.pairwise(labels))


@pytest.mark.parametrize("block", [2, 3, 512])
def test_path_is_the_best(block):
    rng = np.random.default_rng(block)
    counts = np.array([0, 1, 5, 7, 0, 2])
    scores = rng.normal(size=(counts.sum(), 3))
    labels = best_path(scores, counts, 0.8, block)
    first = 0
    for n in counts:
        own = scores[first : first + n]
        best = max(slow_path_value(own, p, 0.8) for p in itertools.product(range(3), repeat=int(n)))
        assert slow_path_value(own, labels[first : first + n].tolist(), 0.8) == pytest.approx(best)
        first += n


def corpus(spark):
    en = "the house and the water of this town with many people near the old river"
    de = "das haus und das wasser dieser stadt mit vielen menschen an dem alten fluss"
    ru = "дом и вода этого города с многими людьми у старой реки"
    uk = "дім і вода цього міста з багатьма людьми біля старої річки"
    rows = [(i, t, k, None) for i, (t, k) in enumerate([(en, "en"), (de, "de"), (ru, "ru"), (uk, "uk")] * 5)]
    return spark.createDataFrame([*rows, (90, None, "en", None), (91, "x", None, None)], "doc_id long, text string, lang string, score string")


def test_spans_scripts_and_odd_rows(spark):
    model = fit(corpus(spark))
    assert model.langs == ["de", "en", "ru", "uk"]
    mixed = "the old water of the town with the people of the house, старой воды города многими людьми этого"
    rows = [(1, mixed), (2, None), (3, ""), (4, "12 !?"), (5, "дом"), (6, "the house"), (6, "the house"), (7, "das wasser und der fluss " * 3000), (8, "İİ the water of the house")]
    got = {r.doc_id: r for r in identify(spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, lang_pred string"), model).collect()}
    assert [s.lang for s in got[1].spans] == ["en", "ru"] and got[1].lang_pred == "en"
    assert mixed[got[1].spans[1].start : got[1].spans[1].end].startswith("старой")
    assert [(got[i].lang_pred, got[i].score, got[i].spans) for i in (2, 3, 4)] == [("und", 0.0, [])] * 3
    assert got[5].lang_pred in ("ru", "uk") and got[6].lang_pred == "en" and got[7].lang_pred == "de"
    assert got[7].score == 1.0


def test_nothing_to_learn_and_empty_tables(spark):
    empty = corpus(spark).limit(0)
    model = fit(empty)
    assert [(r.lang_pred, r.score) for r in identify(corpus(spark).limit(2), model).collect()] == [("und", 0.0)] * 2
    assert identify(empty, fit(corpus(spark))).collect() == []


def test_held_out_accuracy(spark):
    found = op4_language_id(spark, "/root/testdata/sf0.01").where("held_out").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), "doc_id")
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.97


def slow_words(text):
    """First and end character of each run of letters and marks."""
    out, start = [], None
    for i, c in enumerate([*text, " "]):
        inside = unicodedata.category(c)[0] in "LM"
        if inside and start is None:
            start = i
        elif not inside and start is not None:
            out.append((start, i))
            start = None
    return out


def slow_buckets(word):
    points = [0, *(ord(c.lower()) if len(c.lower()) == 1 else ord(c) for c in word), 0]
    for a, b, c in zip(points, points[1:], points[2:]):
        h = (a * 0x9E3779B1 + b * 0x85EBCA77 + c * 0xC2B2AE3D) & 0xFFFFFFFF
        h ^= h >> 15
        yield (h * 0x2C1B3C6D & 0xFFFFFFFF) >> 32 - langid.BUCKET_BITS


def slow_script(char):
    return langid.SCRIPTS[bisect.bisect([a for a, _ in langid.SCRIPTS], ord(char)) - 1][1]


class SlowModel:
    def __init__(self, rows):
        self.langs = sorted({k for _, k in rows})
        self.grams, self.scripts = {k: Counter() for k in self.langs}, {k: Counter() for k in self.langs}
        for text, k in rows:
            for a, b in slow_words(text):
                self.grams[k].update(slow_buckets(text[a:b]))
                self.scripts[k][slow_script(text[a])] += b - a

    def fits(self, script):
        found = {k for k in self.langs if self.scripts[k][script] >= langid.SCRIPT_SHARE * max(1, self.scripts[k].total())}
        return found or set(self.langs)

    def word(self, word, k):
        if k not in self.fits(slow_script(word[0])):
            return -math.inf
        total = self.grams[k].total()
        return sum(math.log((self.grams[k][h] + 0.5) / (total + 0.5 * langid.BUCKETS)) for h in slow_buckets(word))

    def label(self, text):
        words = slow_words(text)
        if not any(unicodedata.category(c)[0] == "L" for c in text):
            return "und", 0.0, []
        paths = {k: (0.0, []) for k in self.langs}
        for a, b in words:
            score = {k: self.word(text[a:b], k) for k in self.langs}
            paths = {k: max((v + score[k] - langid.SWITCH_PENALTY * (p[-1:] not in ([], [k])), [*p, k]) for v, p in paths.values()) for k in self.langs}
        own = max(paths.values())[1]
        mass = {k: sum(b - a for (a, b), x in zip(words, own) if x == k) for k in self.langs}
        best = max(self.langs, key=mass.get)
        spans = []
        for k, run in itertools.groupby(zip(words, own), key=lambda x: x[1]):
            run = [w for w, _ in run]
            spans.append((run[0][0], run[-1][1], k))
        return best, mass[best] / sum(mass.values()), spans


def test_model_and_labels_are_the_plain_ones(spark):
    train = [(r.text, r.lang) for r in corpus(spark).collect() if r.lang and r.text != "x"]
    model, plain = fit(corpus(spark)), SlowModel([(r.text, r.lang) for r in corpus(spark).collect() if r.lang and r.text])
    rnd, parts = random.Random(4), [t.split() for t in sorted({t for t, _ in train if t})]
    texts = []
    for _ in range(60):
        words = [rnd.choice(["", "(", "«"]) + w + rnd.choice(["", ",", ".", " 12"]) for _ in range(rnd.randrange(1, 4)) for p in [rnd.choice(parts)] for w in rnd.sample(p, rnd.randrange(1, 9))]
        texts.append(" ".join(words))
    texts += ["", "12 !", "é́ x", "Ελλάδα the house", "ꙮ", "İstanbul THE HOUSE"]
    for limit in (langid.SLICE_CHARS, 25):
        old, langid.SLICE_CHARS = langid.SLICE_CHARS, limit
        try:
            found = langid.labelled(pa.array(texts), model)
        finally:
            langid.SLICE_CHARS = old
        at = np.concatenate(([0], np.cumsum(found.spans)))
        for i, text in enumerate(texts):
            lang, score, spans = plain.label(text)
            assert ("und" if found.lang[i] < 0 else model.langs[found.lang[i]], found.score[i]) == (lang, pytest.approx(score))
            own = slice(at[i], at[i + 1])
            assert [(a, b, model.langs[k]) for a, b, k in zip(found.start[own].tolist(), found.end[own].tolist(), found.of[own].tolist())] == spans


def test_equal_languages_go_to_the_first_name(spark):
    rows = [(1, "one two three", "b"), (2, "one two three", "a"), (3, "one two three", "c")]
    model = fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert [(r.lang_pred, r.score) for r in identify(spark.createDataFrame(rows, "doc_id long, text string, lang string"), model).collect()] == [("a", 1.0)] * 3
