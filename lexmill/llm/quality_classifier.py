"""Supervised subword embeddings that score text quality.

A document is the average of learned vectors of its words and character n-grams, found by hashing
into buckets; a softmax layer on that average gives the score. Vectors and layer are trained
together by stochastic gradient descent in numpy, on at most ``sample_docs`` labelled documents
chosen by a hash of the id. Executors turn the sampled texts into bucket counts, which bounds what
reaches the driver by sample size times buckets whatever the texts' lengths are, and the sample holds
as many texts as ``sample_docs`` at most, even where documents repeat an id.

Since average and layer are linear up to the softmax, the trained model folds into one weight per
bucket, and scoring is one Arrow pass without a shuffle, over whole texts.

Defined results: a null or empty text gets the score of the layer's bias; without labels to learn
from every score is 0.5; a label that repeats counts as often as it repeats, a null label not at
all; equal hashes in the sample are ordered by id; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET_BITS = 15
BUCKETS = 1 << BUCKET_BITS
ORDERS = (3, 4, 5)
DIMENSIONS = 8
SAMPLE_DOCS = 2000
EPOCHS, BATCH, RATE = 12, 16, 3.0
SLICE_CHARS = 500_000
#: The bucket of repeated words, and what no character is: it ends a text.
AGAIN, END = np.uint32(0), np.uint32(0x110000)
PRIME, SPREAD = np.uint32(0x01000193), np.uint32(0x9E3779B1)


def bucket_runs(points: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Place and bucket of each word, then of each character n-gram, of a text of code points.

    N-grams lie in one word, whose ends count as a character; their place is their second one. A
    word that repeats the one before it counts as the word ``AGAIN``. ``points`` stops with END.
    """
    space = (points == 32) | ((points >= 9) & (points <= 13)) | (points == END)
    chars = np.where(space, np.uint32(0), points + np.uint32(1))
    first = np.flatnonzero(~space & np.concatenate(([True], space[:-1])))
    end = np.flatnonzero(space & np.concatenate(([False], ~space[:-1])))
    if len(first):
        # a word's hash: the sum over its characters of a scramble of character and place in it
        place = np.arange(len(points), dtype=np.uint32) - np.repeat(np.concatenate(([0], first)), np.diff(np.concatenate(([0], first, [len(points)])))).astype(np.uint32)
        mix = (chars * SPREAD) ^ (place * np.uint32(0x85EBCA77))
        mix = (mix ^ (mix >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix, dtype=np.uint64)))
        words = (sums[end] - sums[first]).astype(np.uint32)
        text = np.cumsum(points == END)[first]
        again = np.concatenate(([False], (words[1:] == words[:-1]) & (text[1:] == text[:-1])))
        yield first, np.where(again, AGAIN, (words * SPREAD) >> np.uint32(32 - BUCKET_BITS))
    padded = np.concatenate(([np.uint32(0)], chars))
    rolling = padded.copy()
    inner = np.ones(len(padded), bool)
    for k in range(2, max(ORDERS) + 1):
        n = len(padded) - k + 1
        if n <= 0:
            return
        rolling = rolling[:n] * PRIME ^ padded[k - 1 :]
        if k > 2:
            inner = inner[:n] & (padded[k - 2 : k - 2 + n] > 0)
        if k in ORDERS:
            at = np.flatnonzero(inner[:n])
            h = rolling[at] * SPREAD
            yield at, ((h ^ (h >> np.uint32(13))) * np.uint32(0x85EBCA77)) >> np.uint32(32 - BUCKET_BITS)


def code_points(text: str) -> np.ndarray:
    return np.append(np.frombuffer(text.encode("utf-32-le"), np.uint32), END)


def slices(text: str) -> Iterator[str]:
    start = 0
    while len(text) - start > SLICE_CHARS:
        cut = max(text.rfind(x, start, start + SLICE_CHARS) for x in " \n")
        cut = cut if cut > start else start + SLICE_CHARS
        yield text[start:cut]
        start = cut
    yield text[start:]


@dataclass
class Model:
    vectors: np.ndarray  # (buckets, dimensions)
    layer: np.ndarray  # (dimensions, classes)
    bias: np.ndarray  # (classes,)

    def folded(self) -> tuple[np.ndarray, float]:
        """One weight per bucket, and the bias, of the log odds of class 1."""
        return (self.vectors @ (self.layer[:, 1] - self.layer[:, 0])).astype(np.float32), float(self.bias[1] - self.bias[0])


def train(rows: list[tuple[int, np.ndarray, np.ndarray]], *, epochs: int = EPOCHS, rate: float = RATE, seed: int = 7) -> Model:
    """Fits vectors and layer to (label, buckets, counts) by stochastic gradient descent."""
    rng = np.random.default_rng(seed)
    model = Model(rng.uniform(-1, 1, (BUCKETS, DIMENSIONS)) / DIMENSIONS, np.zeros((DIMENSIONS, 2)), np.zeros(2))
    rows = [r for r in rows if len(r[1])]
    steps = max(1, epochs * -(-len(rows) // BATCH))
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for b in range(0, len(rows), BATCH):
            batch = [rows[i] for i in order[b : b + BATCH]]
            now, step = rate * (1 - step / steps), step + 1
            ids = np.concatenate([r[1] for r in batch])
            weights = np.concatenate([r[2] / r[2].sum() for r in batch])
            sizes = np.array([len(r[1]) for r in batch])
            begin = np.cumsum(sizes) - sizes
            mean = np.add.reduceat(model.vectors[ids] * weights[:, None], begin, axis=0)
            logits = mean @ model.layer + model.bias
            odds = np.exp(logits - logits.max(axis=1, keepdims=True))
            error = odds / odds.sum(axis=1, keepdims=True)
            error[np.arange(len(batch)), [r[0] for r in batch]] -= 1
            pull = error @ model.layer.T
            model.layer -= now * mean.T @ error / len(batch)
            model.bias -= now * error.mean(axis=0) * 0.1
            # each row's gradient spreads over its buckets by their share; a batch has most buckets, so
            # one sum over all cells of the table is quicker than to pick out its own
            change = np.repeat(pull, sizes, axis=0) * weights[:, None]
            cells = (ids[:, None] * DIMENSIONS + np.arange(DIMENSIONS)).ravel()
            model.vectors -= now * np.bincount(cells, change.ravel(), BUCKETS * DIMENSIONS).reshape(BUCKETS, DIMENSIONS)
    return model


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", usable: Column | None = None, sample_docs: int = SAMPLE_DOCS) -> Model:
    """Learns from at most ``sample_docs`` rows of ``labels`` (0 or 1) and the texts of their ids."""
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
    known = known.where(usable) if usable is not None else known
    chosen = known.select(id_col, F.col(label_col).cast("int").alias("label")).orderBy(F.xxhash64(id_col), id_col, "label").limit(sample_docs)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, counts = [], []
            for text in batch.column(2).to_pylist():
                held = np.zeros(BUCKETS, np.int64)
                for part in slices(text or ""):
                    for _, buckets in bucket_runs(code_points(part)):
                        held += np.bincount(buckets, minlength=BUCKETS)
                ids.append(np.flatnonzero(held).astype(np.int32))
                counts.append(held[ids[-1]].astype(np.int32))
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ids, kind), pa.array(counts, kind)], ["doc_id", "label", "ids", "counts"])

    # at most sample_docs rows of two numbers: a bounded broadcast
    texts = docs.select(id_col, text_col).join(F.broadcast(chosen), id_col).select(id_col, "label", text_col)
    # ids may repeat among the documents too
    texts = texts.orderBy(F.xxhash64(id_col), id_col, "label", F.xxhash64(text_col)).limit(sample_docs)
    kind = docs.schema[id_col].dataType.simpleString()
    found = texts.mapInArrow(count, f"doc_id {kind}, label int, ids array<int>, counts array<int>").toArrow()
    return train(sampled_rows(found))


def sampled_rows(found: pa.Table) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Label, buckets and counts of each sampled text, in an order that doesn't depend on partitions;
    the arrays are views of the table's."""
    rows = []
    for batch in found.to_batches():
        lists = [batch.column(k) for k in ("ids", "counts")]
        at = lists[0].offsets.to_numpy()
        ids, counts = (x.values.to_numpy() for x in lists)
        for i, (key, label) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("label").to_pylist(), strict=True)):
            rows.append((key, label, ids[at[i] : at[i + 1]], counts[at[i] : at[i + 1]]))
    rows.sort(key=lambda r: (r[0], r[1], r[2].tobytes(), r[3].tobytes()))
    return [r[1:] for r in rows]


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score``: the probability of label 1 of each row."""
    weights, bias = model.folded()

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums, grams = np.zeros(batch.num_rows), np.zeros(batch.num_rows)
            held: list[tuple[int, str]] = []
            size = 0

            def settle() -> None:
                """Adds up weights of the held slices, hashed in one go."""
                points = np.concatenate([code_points(x) for _, x in held])
                rows = np.array([i for i, _ in held])
                bounds = np.cumsum([0] + [len(x) + 1 for _, x in held])
                for place, buckets in bucket_runs(points):
                    ends = np.searchsorted(place, bounds)
                    total = np.concatenate(([0], np.cumsum(weights[buckets], dtype=np.float64)))
                    np.add.at(sums, rows, total[ends[1:]] - total[ends[:-1]])
                    np.add.at(grams, rows, np.diff(ends))

            for i, text in enumerate(batch.column(1).to_pylist()):
                for part in slices(text or ""):
                    held.append((i, part))
                    size += len(part)
                    if size > SLICE_CHARS:
                        settle()
                        held, size = [], 0
            if held:
                settle()
            odds = sums / np.maximum(1, grams) + bias
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-odds)))], ["doc_id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(predict, f"doc_id {kind}, score double")
