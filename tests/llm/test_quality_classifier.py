"""The quality classifier: features, folded scoring, odd rows and held-out accuracy."""

import numpy as np
import pytest

from lexmill.llm import quality_classifier as q
from lexmill.llm.queries import op7_quality_classifier


def slow_grams(text):
    """Words, then n-grams with word ends, as strings."""
    words = [w for w in text.replace("\t", " ").replace("\n", " ").split(" ") if w]
    grams = []
    for k in q.ORDERS:
        for w in words:
            padded = "\0" + w + "\0"
            grams += [padded[i : i + k] for i in range(len(padded) - k + 1)]
    return words, grams


@pytest.mark.parametrize("text", ["", " ", "a", "ab cd", "The  cat\tsat É 𝒳\non the mat ab"])
def test_features_are_words_and_grams(text):
    runs = list(q.bucket_runs(q.code_points(text)))
    words, grams = slow_grams(text)
    sizes = [len(b) for _, b in runs]
    # an n-gram that starts at a word's end and stops at the next word's start isn't in a word
    assert sum(sizes) == len(words) + len(grams)
    if words:
        by = {}
        for w, b in zip(words, runs[0][1]):
            assert by.setdefault(w, b) == b


def test_scores_do_not_depend_on_slices(spark, monkeypatch):
    rng = np.random.default_rng(0)
    model = q.Model(rng.normal(size=(q.BUCKETS, q.DIMENSIONS)), rng.normal(size=(q.DIMENSIONS, 2)), rng.normal(size=2))
    texts = [None, "", "one two three " * 50, "x", "é" * 400, "one two three " * 50]
    df = spark.createDataFrame([(i, t, "c") for i, t in enumerate(texts)], "doc_id long, text string, score string")
    got = [r.score for r in q.score(df, model).orderBy("doc_id").collect()]
    weights, bias = model.folded()
    for value, text in zip(got, texts):
        ids = np.concatenate([b for _, b in q.bucket_runs(q.code_points(text or ""))] or [np.zeros(0, int)])
        want = 1 / (1 + np.exp(-(weights[ids].astype(float).sum() / max(1, len(ids)) + bias)))
        assert value == pytest.approx(want, abs=1e-6)
    assert got[2] == got[5] and got[0] == got[1]


def slow_train(rows, epochs, rate, seed):
    """Stochastic gradient descent, one number at a time; the layer's and the bias's steps come first."""
    rng = np.random.default_rng(seed)
    vectors, layer, bias = (rng.uniform(-1, 1, (q.BUCKETS, q.DIMENSIONS)) / q.DIMENSIONS), [[0.0, 0.0] for _ in range(q.DIMENSIONS)], [0.0, 0.0]
    steps, step = epochs * -(-len(rows) // q.BATCH), 0
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for b in range(0, len(rows), q.BATCH):
            now, step = rate * (1 - step / steps), step + 1
            batch = [rows[i] for i in order[b : b + q.BATCH]]
            layer_step, bias_step, vector_step = [[0.0, 0.0] for _ in range(q.DIMENSIONS)], [0.0, 0.0], {}
            for label, ids, counts in batch:
                total = sum(counts)
                mean = [sum(c / total * vectors[i][d] for i, c in zip(ids, counts)) for d in range(q.DIMENSIONS)]
                logits = [sum(mean[d] * layer[d][k] for d in range(q.DIMENSIONS)) + bias[k] for k in (0, 1)]
                odds = [np.exp(x - max(logits)) for x in logits]
                error = [odds[k] / sum(odds) - (k == label) for k in (0, 1)]
                for d in range(q.DIMENSIONS):
                    pull = sum(error[k] * layer[d][k] for k in (0, 1))
                    for k in (0, 1):
                        layer_step[d][k] += mean[d] * error[k] / len(batch)
                    for i, c in zip(ids, counts):
                        vector_step[i, d] = vector_step.get((i, d), 0.0) + pull * c / total
                for k in (0, 1):
                    bias_step[k] += error[k] / len(batch) * 0.1
            for d in range(q.DIMENSIONS):
                for k in (0, 1):
                    layer[d][k] -= now * layer_step[d][k]
            bias = [bias[k] - now * bias_step[k] for k in (0, 1)]
            for (i, d), x in vector_step.items():
                vectors[i][d] -= now * x
    return vectors, layer, bias


def test_training_is_plain_gradient_descent():
    rng = np.random.default_rng(3)
    rows = []
    for _ in range(40):
        ids = np.sort(rng.choice(60, rng.integers(1, 12), replace=False))
        rows.append((int(ids[0] % 2), ids.astype(np.int64), rng.integers(1, 5, len(ids)).astype(np.float64)))
    model = q.train([*rows, (1, np.zeros(0, np.int64), np.zeros(0))], epochs=3, rate=0.7, seed=5)
    vectors, layer, bias = slow_train(rows, 3, 0.7, 5)
    assert np.allclose(model.vectors, vectors) and np.allclose(model.layer, layer) and np.allclose(model.bias, bias)


def test_gradients_are_those_of_the_loss():
    rows = [(1, np.array([2, 5]), np.array([1.0, 3.0])), (0, np.array([5, 9]), np.array([2.0, 2.0]))]

    def loss(m):
        out = 0.0
        for label, ids, counts in rows:
            logits = (counts / counts.sum()) @ m.vectors[ids] @ m.layer + m.bias
            out -= logits[label] - np.log(np.exp(logits).sum())
        return out / len(rows)

    # the first step leaves the vectors alone, as the layer is zero: two steps tell the layer's change
    small = 1e-4
    before = q.train(rows, epochs=1, rate=0.0, seed=1)
    after = q.train(rows, epochs=1, rate=small, seed=1)
    for d in range(q.DIMENSIONS):
        for k in (0, 1):
            up = q.Model(before.vectors, before.layer.copy(), before.bias)
            up.layer[d, k] += 1e-5
            slope = (loss(up) - loss(before)) / 1e-5
            assert (after.layer - before.layer)[d, k] == pytest.approx(-small * slope, abs=1e-9)


def test_repeated_ids_stay_within_the_sample(spark):
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(50)] + [(2, "b")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 0)], "doc_id long, quality int")
    seen = []
    q_train, q.train = q.train, lambda rows, **k: seen.extend(rows) or q_train(rows, **k)
    try:
        q.fit(docs, labels, sample_docs=10)
    finally:
        q.train = q_train
    assert len(seen) == 10


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, None, 0)], "doc_id long, quality int, toxic int")
    assert [r.score for r in q.score(docs, q.fit(docs, labels)).collect()] == [0.5, 0.5]
    assert q.score(docs.limit(0), q.fit(docs, labels)).collect() == []


def test_held_out_accuracy(spark):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = op7_quality_classifier(spark, "/root/testdata/sf0.1").where("held_out").join(labels, "doc_id").collect()
    good, bad = [r.predicted for r in rows if r.quality == 1], [r.predicted for r in rows if r.quality == 0]
    print(len(good), np.mean(good), len(bad), np.mean(bad))
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.15
