"""Product codes of vectors, with codebooks from Lloyd rounds that filter on kd-trees.

A component ``x`` becomes the integer ``floor(4096 * x)``; all sums, distances and means are of
integers, so that the result is the same however the rows are dealt out. A vector is cut into
``PARTS`` equal parts, and each part position has a codebook of up to ``ENTRIES`` entries.

Vectors are gathered, where they lie, into blocks of ``BLOCK``. For each part position a block gets
a kd-tree: nodes halve their points along the widest side of their box, level by level in numpy, and
keep the box and the sum of their points (their number follows from the node's place). The trees are
stored once. A round walks every tree from its root with the set of entries that may be nearest to a
point of the node: of the entries, that nearest to the middle of the box dismisses every other that is
farther from the corner of the box where that one is best. A node with one entry left is settled as
a whole by its cached sum; leaves that aren't settled compare their points one by one. Tasks
return sums by entry, which Spark adds up; the driver gets one row for each entry and component.

Defined results: rows whose vector is null or holds a null or a number that isn't finite are dropped; a
null id is encoded like others and comes after all ids among the first ``ENTRIES`` rows, which
begin the codebooks (rows of one id: by their components); fewer rows make smaller codebooks; a
null label is a label of its own; extra columns are ignored, whatever their names; a table without
usable rows gives no rows. Vectors of different lengths, of no components or a number that
``PARTS`` doesn't divide, and components so large that distances would leave 64 bits are errors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.operators.keyed import lookup
from lexmill.storage import scratched

from .shared import named, stored, trimmed

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Vectors in a block, and points in a leaf at most.
BLOCK, LEAF = 4096, 16


def length_of(sizes: list[int]) -> int:
    """The one length of all vectors."""
    if len(set(sizes)) != 1 or not sizes[0] or sizes[0] % PARTS:
        raise ValueError(f"vectors have {sorted(set(sizes))} components: one number, a multiple of {PARTS}, is needed")
    return sizes[0]


def whole(values: np.ndarray, dims: int) -> np.ndarray:
    """Components as integers, whose squared distances stay within 64 bits."""
    found = np.floor(values.astype(np.float64) * SCALE)
    if found.size and 16 * dims * float(np.abs(found).max()) ** 2 >= 2.0**62:
        raise ValueError(f"components are too large for exact distances of {dims} of them")
    return found.astype(np.int64)


def depth_of(n: int) -> int:
    """Levels below the root of a tree over ``n`` points."""
    return max(0, int(np.ceil(np.log2(max(1, n) / LEAF))))


def bounds(n: int, level: int) -> np.ndarray:
    """Where the nodes of a level begin and end among ``n`` points in the tree's order."""
    return np.arange((1 << level) + 1, dtype=np.int64) * n >> level


def grow(points: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """A kd-tree: the order of the points, and each level's lower corners, upper corners and sums."""
    n, order, levels = len(points), np.arange(len(points)), []
    for level in range(depth_of(n) + 1):
        cut = bounds(n, level)
        mine = points[order]
        low, high = np.minimum.reduceat(mine, cut[:-1]), np.maximum.reduceat(mine, cut[:-1])
        levels.append((low, high, np.add.reduceat(mine, cut[:-1])))
        if level < depth_of(n):
            node = np.repeat(np.arange(1 << level), np.diff(cut))
            order = order[np.lexsort((mine[np.arange(n), (high - low).argmax(1)[node]], node))]
    return order, levels


def distances(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of all points to all entries."""
    return (points * points).sum(1)[:, None] - 2 * (points @ entries.T) + (entries * entries).sum(1)


def ranges(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All indexes of several ranges."""
    size = end - begin
    return np.repeat(begin - np.cumsum(size) + size, size) + np.arange(size.sum())


def settle(points: np.ndarray, levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]], entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The nearest entry of each point in the tree's order, the sums and counts by entry, and how
    many points were compared one by one."""
    n, k = len(points), len(entries)
    codes, sums, counts = np.zeros(n, np.int64), np.zeros_like(entries), np.zeros(k, np.int64)
    nodes, may = np.zeros(1, np.int64), np.ones((1, k), bool)
    norms, compared = (entries * entries).sum(1), 0
    for level, (low, high, cached) in enumerate(levels):
        cut = bounds(n, level)
        a, b = low[nodes], high[nodes]
        best = np.where(may, distances(a + b, 2 * entries), np.iinfo(np.int64).max).argmin(1)
        gap = entries[None] - entries[best][:, None]
        most = np.where(gap > 0, b[:, None] * gap, a[:, None] * gap).sum(2)  # the corner where an entry does best
        farther = norms[None] - norms[best][:, None] - 2 * most
        may &= ~((farther > 0) | ((farther == 0) & (best[:, None] < np.arange(k))))
        alone = may.sum(1) == 1
        whose, taken = best[alone], nodes[alone]
        np.add.at(sums, whose, cached[taken])
        np.add.at(counts, whose, cut[taken + 1] - cut[taken])
        codes[ranges(cut[taken], cut[taken + 1])] = np.repeat(whose, cut[taken + 1] - cut[taken])
        nodes, may = nodes[~alone], may[~alone]
        if level + 1 < len(levels):
            nodes, may = (2 * nodes[:, None] + np.arange(2)).ravel(), np.repeat(may, 2, axis=0)
    left = ranges(bounds(n, len(levels) - 1)[nodes], bounds(n, len(levels) - 1)[nodes + 1])
    if len(left):
        nearest = distances(points[left], entries).argmin(1)
        codes[left], compared = nearest, len(left)
        np.add.at(sums, nearest, points[left])
        np.add.at(counts, nearest, 1)
    return codes, sums, counts, compared


def pack(ids: pa.Array, labels: pa.Array, vectors: np.ndarray) -> dict:
    """A block: its rows' ids and labels, and for each part position the points in the tree's order,
    that order, and the nodes, as bytes."""
    width = vectors.shape[1] // PARTS
    orders, points, nodes = [], [], []
    for p in range(PARTS):
        mine = vectors[:, p * width : (p + 1) * width]
        order, levels = grow(mine)
        orders.append(order.astype(np.int32))
        points.append(mine[order].astype(np.int32))
        nodes += [x for level in levels for x in level]
    return {"ids": ids, "labels": labels, "width": width, "orders": b"".join(x.tobytes() for x in orders), "points": b"".join(x.tobytes() for x in points), "nodes": b"".join(x.tobytes() for x in nodes)}


def unpack(n: int, row: dict) -> Iterator[tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]]:
    """Order, points and tree of each part position of a block."""
    width = row["width"]
    orders = np.frombuffer(row["orders"], np.int32).reshape(PARTS, n)
    points = np.frombuffer(row["points"], np.int32).reshape(PARTS, n, width)
    nodes, at = np.frombuffer(row["nodes"], np.int64).reshape(-1, width), 0
    for p in range(PARTS):
        levels = []
        for level in range(depth_of(n) + 1):
            low, high, sums = nodes[at : at + (3 << level)].reshape(3, 1 << level, width)
            levels.append((low, high, sums))
            at += 3 << level
        yield orders[p], points[p].astype(np.int64), levels


def usable(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``id``, ``label`` and ``vector`` of rows whose vector has only finite numbers."""
    rows = named(vectors, id=id_col, label=label_col, vector=vector_col).withColumn("vector", F.col("vector").cast("array<double>"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(F.col("vector").isNotNull() & ~bad)


def blocks(rows: DataFrame) -> DataFrame:
    """Blocks with their trees, one row each, of rows that lie together."""
    ids, labels = rows.schema["id"].dataType, rows.schema["label"].dataType
    schema = T.StructType([T.StructField("ids", T.ArrayType(ids)), T.StructField("labels", T.ArrayType(labels)), T.StructField("width", T.IntegerType()), *[T.StructField(c, T.BinaryType()) for c in ("orders", "points", "nodes")]])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def block(part: pa.Table) -> pa.RecordBatch:
            vectors = part["vector"].combine_chunks()
            dims = length_of(np.unique(vectors.value_lengths().to_numpy(zero_copy_only=False)).tolist())
            numbers = whole(vectors.flatten().to_numpy(zero_copy_only=False), dims).reshape(len(part), dims)
            row = pack(part["id"].combine_chunks(), part["label"].combine_chunks(), numbers)
            one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
            return pa.RecordBatch.from_arrays([one(row["ids"]), one(row["labels"]), pa.array([row["width"]], pa.int32()), *[pa.array([row[c]], pa.binary()) for c in ("orders", "points", "nodes")]], names=schema.names)

        for batch in batches:
            held.append(batch)
            while sum(map(len, held)) >= BLOCK:
                there = pa.Table.from_batches(held)
                yield block(there.slice(0, BLOCK))
                held = there.slice(BLOCK).to_batches()
        if sum(map(len, held)):
            yield block(pa.Table.from_batches(held))

    return rows.mapInArrow(trimmed(gather), schema)


def round_sums(trees: DataFrame, books: np.ndarray) -> np.ndarray:
    """Sums by position, entry and component, and in one component more the counts, of all blocks."""
    _, entries, width = books.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((PARTS, entries, width + 1), np.int64)
        for batch in batches:
            for i in range(len(batch)):
                row = {c: batch[c][i].as_py() for c in ("width", "points", "nodes", "orders")}
                for p, (_, points, levels) in enumerate(unpack(len(batch["ids"][i].values), row)):
                    _, sums, counts, _ = settle(points, levels, books[p])
                    total[p, :, :width] += sums
                    total[p, :, width] += counts
        at = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([*[pa.array(x.astype(np.int32)) for x in at], pa.array(total[at])], names=["part", "entry", "component", "value"])

    found = np.zeros((PARTS, entries, width + 1), object)
    for r in trees.mapInArrow(trimmed(add), "part int, entry int, component int, value long").groupBy("part", "entry", "component").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect():
        found[r.part, r.entry, r.component] = int(r.value)
    return found


def fit(trees: DataFrame, seeds: np.ndarray, *, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks by position, entry and component, after ``rounds`` of Lloyd from ``seeds``, the first vectors."""
    books = seeds.reshape(len(seeds), PARTS, -1).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        found = round_sums(trees, books)
        sums, counts = found[:, :, :-1], found[:, :, -1:]
        books = np.where(counts > 0, sums // np.maximum(counts, 1), books).astype(np.int64)
    return books


def assign(trees: DataFrame, books: np.ndarray) -> DataFrame:
    """``id``, ``label``, ``code`` and ``error`` of every row."""
    ids, labels = (trees.schema[c].dataType.elementType for c in ("ids", "labels"))
    schema = T.StructType([T.StructField("id", ids), T.StructField("label", labels), T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                n = len(batch["ids"][i].values)
                codes, error = np.zeros((n, PARTS), np.uint8), np.zeros(n, np.int64)
                row = {c: batch[c][i].as_py() for c in ("width", "points", "nodes", "orders")}
                for p, (order, points, levels) in enumerate(unpack(n, row)):
                    mine = settle(points, levels, books[p])[0]
                    gap = points - books[p][mine]
                    codes[order, p] = mine
                    error[order] += (gap * gap).sum(1)
                text = codes.tobytes().hex()
                width = 2 * PARTS
                yield pa.RecordBatch.from_arrays([batch["ids"][i].values, batch["labels"][i].values, pa.array([text[j * width : (j + 1) * width] for j in range(n)]), pa.array(error)], names=schema.names)

    return trees.mapInArrow(trimmed(encode), schema)


def books_digest(books: np.ndarray) -> str:
    """SHA-256 of all entries' components by position, entry and component."""
    return hashlib.sha256(",".join(str(x) for x in books.ravel().tolist()).encode()).hexdigest()


@scratched("vector-codes")
def vector_codes(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", rounds: int = ROUNDS) -> DataFrame:
    """``id_col``, ``code``, ``error``, ``label_error`` and ``codebooks_sha256`` of every usable row."""
    rows = usable(vectors, id_col, vector_col, label_col)
    first = rows.orderBy(F.asc_nulls_last("id"), "vector").limit(ENTRIES).select("vector").collect()
    if not first:
        return rows.select(F.col("id").alias(id_col), F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    dims = length_of([len(r.vector) for r in first])
    seeds = whole(np.array([r.vector for r in first]), dims)
    trees = stored(blocks(rows), "kd-trees")
    books = fit(trees, seeds, rounds=rounds)
    coded = stored(assign(trees, books).withColumn("key", F.struct("label")), "codes")
    by_label = coded.groupBy("key").agg(F.sum("error").alias("label_error"), F.count("*").alias("n"))
    found = lookup(coded, by_label, "key", "n", coded.count())
    return found.select(F.col("id").alias(id_col), "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))
