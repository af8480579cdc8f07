"""Product codes against plain Lloyd rounds."""

import hashlib

import numpy as np
import pytest

from lexmill.llm import vector_codes as vc


def slow_codes(rows, rounds=vc.ROUNDS):
    """``rows``: (id, vector, label); ids may be null, in which case they come last."""
    kept = [(i, v, label) for i, v, label in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    if not kept:
        return []
    ints = {j: [int(np.floor(np.float64(x) * 4096)) for x in v] for j, (_, v, _) in enumerate(kept)}
    width = len(kept[0][1]) // 8
    seeds = sorted(ints, key=lambda j: (kept[j][0] is None, kept[j][0] or 0, kept[j][1]))[:16]
    part = lambda j, p: ints[j][p * width : (p + 1) * width]
    books = [[part(j, p) for j in seeds] for p in range(8)]
    near = lambda v, book: min((sum((a - b) ** 2 for a, b in zip(v, e)), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p in range(8):
            groups = {}
            for j in ints:
                groups.setdefault(near(part(j, p), books[p])[1], []).append(part(j, p))
            books[p] = [[sum(c) // len(groups[k]) for c in zip(*groups[k])] if k in groups else e for k, e in enumerate(books[p])]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    best = {j: [near(part(j, p), books[p]) for p in range(8)] for j in ints}
    error = {j: sum(d for d, _ in best[j]) for j in ints}
    by_label = {}
    for j in ints:
        by_label[kept[j][2]] = by_label.get(kept[j][2], 0) + error[j]
    return [(kept[j][0], "".join(f"{k:02x}" for _, k in best[j]), error[j], by_label[kept[j][2]], digest) for j in ints]


@pytest.mark.parametrize("n, spread", [(1, 1.0), (15, 1.0), (700, 0.3), (700, 0.0005)])
def test_filter_settles_as_brute_force(n, spread):
    rng = np.random.default_rng(n)
    points = np.floor(rng.normal(0, spread, (n, 3)) * 4096).astype(np.int64)
    points[: n // 3] = points[0]
    entries = points[rng.integers(0, n, 16)]  # with equal entries: ties go to the lower
    order, levels = vc.grow(points)
    codes, sums, counts, compared = vc.settle(points[order], levels, entries)
    slow = ((points[order][:, None] - entries[None]) ** 2).sum(2).argmin(1)
    assert (codes == slow).all() and counts.sum() == n and compared <= n
    assert all((sums[k] == points[order][slow == k].sum(0)).all() for k in range(16))


def test_settles_most_without_comparing():
    rng = np.random.default_rng(0)
    middles = rng.integers(-4000, 4000, (16, 8))
    points = middles[rng.integers(0, 16, 4096)] + rng.integers(-40, 40, (4096, 8))
    order, levels = vc.grow(points)
    assert vc.settle(points[order], levels, middles)[3] < 400


@pytest.mark.parametrize("block", [4096, 23])
def test_matches_plain_rounds(spark, monkeypatch, block):
    monkeypatch.setattr(vc, "BLOCK", block)
    rng = np.random.default_rng(1)
    rows = [(int(i), [float(x) for x in rng.normal(0, 0.2, 16).astype(np.float32)], int(i % 3) if i % 7 else None) for i in rng.permutation(150)]
    rows += [(3000 + i, rows[0][1], 1) for i in range(60)]  # copies of one vector
    rows += [rows[5], rows[5], (None, rows[7][1], 0), (-4, None, 1), (-5, [1.0] * 15 + [None], 1), (-6, [float("nan")] * 16, 0), (-7, [float("inf")] * 16, 0), (-8, [-0.00001] * 16, 2)]
    df = spark.createDataFrame([(*r, "x", 7, 9) for r in rows], "vec_id long, embedding array<float>, label int, Label string, id int, code int").repartition(3)
    got = sorted(map(tuple, vc.vector_codes(df).collect()), key=str)
    assert got == sorted(slow_codes(rows), key=str)


def test_few_rows_and_none(spark):
    schema = "vec_id long, embedding array<double>, label string"
    rows = [(2, [0.5] * 8, None), (1, [0.25] * 8, None), (3, None, "a")]
    assert sorted(map(tuple, vc.vector_codes(spark.createDataFrame(rows, schema)).collect())) == sorted(slow_codes(rows))
    for rows in ([], [(1, None, "a"), (None, None, None)]):
        found = vc.vector_codes(spark.createDataFrame(rows, schema))
        assert found.collect() == [] and found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


@pytest.mark.parametrize("vectors", [[[1.0] * 8, [1.0] * 16], [[1.0] * 9], [[]], [[1e30] * 8]])
def test_refused(spark, vectors):
    with pytest.raises(Exception, match="components|too large"):
        vc.vector_codes(spark.createDataFrame([(i, v, 0) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, label int")).collect()
