"""SimHash near-duplicate groups by a binary-trie self-join.

Fingerprints come from one Arrow pass over whole texts. Equal fingerprints fold into one row with
their smallest id before anything is joined, so a group of exact copies costs one row; back again, rows of
very common fingerprints learn their label without a shuffle. The distinct
fingerprints are then joined: two of them within ``radius`` bits agree on at least one of
``radius + 1`` blocks of bits, so each goes once to each of its blocks, and within a block a binary
trie is traversed as pairs of nodes, adding up the bits by which their prefixes differ and leaving
a pair as soon as that sum exceeds the budget. A block with too many rows is split along the same
trie into pairs of subtrees, level by level, until each part fits in a task; no rows are left out.

Each part returns a forest instead of all its links, so its output never exceeds its input;
components of the forest's edges come from alternating large and small stars.

Defined results: a null or empty text has fingerprint zero and is linked like any other; repeated
rows share a fingerprint, and unrelated texts of one id don't; a null id is never a component's
smallest; an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.operators.components import components
from lexmill.operators.keyed import lookup
from lexmill.storage import scratched

from .shared import byte_slices, stored, trimmed

SHINGLE_WORDS = 3
SEED = 42
RADIUS = 2
BITS = 64
#: Rows that a part of the join may hold, and bits by which a larger part is split at a time.
PART_ROWS, SPLIT_BITS = 50_000, 3
#: Node pairs of fewer pairs of rows than this are compared outright.
LEAF_PAIRS = 4096
HASHES_AT_ONCE, SLICE_BYTES = 200_000, 1_000_000


def shingle_hashes(text: bytes, shingle_words: int) -> Iterator[np.ndarray]:
    """Hashes of the word shingles of a UTF-8 text in order, ASCII letters folded, slice by slice."""
    held: list[bytes] = []
    whole, digest = True, xxhash.xxh64_intdigest
    for part in byte_slices(text, SLICE_BYTES):
        words = held + part.lower().split()
        held = words
        if len(words) < shingle_words:
            continue
        joined = b" ".join(words)
        ends = (np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1).tolist()
        starts = [0] + [e + 1 for e in ends[:-shingle_words]]
        yield np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle_words - 1 :], strict=True)), np.uint64, len(starts))
        whole, held = False, words[len(words) - shingle_words + 1 :]
    if whole and held:
        yield np.array([digest(b" ".join(held), SEED)], np.uint64)


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How often each of the 64 bits is set."""
    counts = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), HASHES_AT_ONCE):
        part = hashes[i : i + HASHES_AT_ONCE]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return counts


def majority(counts: np.ndarray, n: int) -> int:
    """The bits that are set in over half of ``n`` hashes."""
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """SimHash of the word shingles of a UTF-8 text; memory doesn't grow with its words."""
    counts, n = np.zeros(BITS, np.int64), 0
    for hashes in shingle_hashes(text, shingle_words):
        counts, n = counts + bit_counts(hashes), n + len(hashes)
    return majority(counts, n)


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``fp``, the fingerprint as a signed long."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            found = np.fromiter((fingerprint(x.as_py() or b"") for x in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(trimmed(compute), f"doc_id {kind}, fp long")


def differing_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def trie_links(left: np.ndarray, right: np.ndarray | None, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs within ``radius`` bits between two sorted arrays, or inside ``left``.

    A node is a range of a sorted array whose members share their leading bits; the stack holds
    pairs of nodes at one depth with the bits by which their prefixes differ.
    """
    own = right is None
    right = left if own else right
    stack = [(0, len(left), 0, len(right), BITS - 1, 0)]
    while stack:
        a0, a1, b0, b1, bit, differ = stack.pop()
        if a0 >= a1 or b0 >= b1 or differ > radius:
            continue
        if bit < 0 or (a1 - a0) * (b1 - b0) <= LEAF_PAIRS:
            i, j = np.nonzero(differing_bits(left[a0:a1, None], right[None, b0:b1]) <= radius)
            i, j = i + a0, j + b0
            keep = i < j if own else slice(None)
            yield i[keep], j[keep]
            continue
        mask = np.uint64(1 << bit)
        a = a0 + int(np.searchsorted(left[a0:a1] & mask, mask)) if left[a0] & mask != left[a1 - 1] & mask else (a0 if left[a0] & mask else a1)
        b = b0 + int(np.searchsorted(right[b0:b1] & mask, mask)) if right[b0] & mask != right[b1 - 1] & mask else (b0 if right[b0] & mask else b1)
        same = own and a0 == b0 and a1 == b1
        stack += [(a0, a, b0, b, bit - 1, differ), (a, a1, b, b1, bit - 1, differ), (a0, a, b, b1, bit - 1, differ + 1)]
        if not same:
            stack.append((a, a1, b0, b, bit - 1, differ + 1))


def forest(size: int, links: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The root of each of ``size`` nodes; a root is the smallest index of its tree."""
    root = np.arange(size)
    for i, j in links:
        while len(i):
            a, b = root[i], root[j]
            while (a != root[a]).any():
                a = root[a]
            while (b != root[b]).any():
                b = root[b]
            apart = a != b
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
    while (root != root[root]).any():
        root = root[root]
    return root


def block_edges(radius: int) -> list[tuple[int, int]]:
    """First bit and width of ``radius + 1`` blocks that together cover all bits."""
    edges = [BITS * i // (radius + 1) for i in range(radius + 2)]
    return [(a, b - a) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def turned(fp: str, first: int) -> F.Column:
    """``fp`` rotated so that bit ``first`` becomes the lowest; distances stay."""
    return F.shiftrightunsigned(fp, first).bitwiseOR(F.shiftleft(fp, BITS - first)) if first else F.col(fp)


def parts_of(distinct: DataFrame, radius: int, part_rows: int) -> DataFrame:
    """Rows ``part, side, differ, fp, node``: the work of each task of the join.

    A part is one block's value, or a pair of subtrees of it. ``fp`` is rotated so that the
    block's own bits, equal in the whole part, come last in the trie; ``differ`` counts the bits
    by which the two nodes differ so far. ``side`` is 0 where both nodes are the same, else 1 or 2.
    Parts of over ``part_rows`` rows are split by their next bits.
    """
    blocks = []
    for i, (first, width) in enumerate(block_edges(radius)):
        value = turned("fp", first).bitwiseAND((1 << width) - 1)
        blocks.append(F.struct(F.concat_ws(":", F.lit(i), value).alias("part"), turned("fp", first).alias("fp")))
    rows = distinct.select("node", F.explode(F.array(*blocks)).alias("b")).select("b.part", F.lit(0).alias("side"), F.lit(0).alias("differ"), "b.fp", "node")
    done, depth = None, 0
    while depth < BITS:
        sizes = rows.groupBy("part").count()
        large = stored(sizes.where(F.col("count") > part_rows).select("part"), "large-parts")
        if large.isEmpty():
            break
        small = rows.join(large, "part", "left_anti")
        done = small if done is None else done.unionByName(small)
        hot = rows.join(large, "part", "left_semi")
        # the next bits, from the highest: node pairs at most `radius` bits apart stay
        take = min(SPLIT_BITS, BITS - depth)
        own = F.shiftrightunsigned("fp", BITS - depth - take).bitwiseAND((1 << take) - 1).cast("int")
        pairs = []
        for other in range(1 << take):
            apart = F.bit_count(own.bitwiseXOR(F.lit(other)))
            low, high = F.least(own, F.lit(other)), F.greatest(own, F.lit(other))
            first = F.when(F.col("side") == 0, F.when(own == other, 0).when(own < other, 1).otherwise(2)).otherwise(F.col("side"))
            name = F.when(F.col("side") == 0, F.concat_ws("-", low, high)).when(F.col("side") == 1, F.concat_ws("-", own, F.lit(other))).otherwise(F.concat_ws("-", F.lit(other), own))
            pairs.append(F.when(F.col("differ") + apart <= radius, F.struct(F.concat_ws("/", "part", name).alias("part"), first.alias("side"), (F.col("differ") + apart).alias("differ"))))
        rows = stored(hot.select("fp", "node", F.explode(F.array_compact(F.array(*pairs))).alias("p")).select("p.part", "p.side", "p.differ", "fp", "node"), "split-parts")
        depth += take
    return rows if done is None else done.unionByName(rows)


def fingerprint_edges(distinct: DataFrame, *, radius: int = RADIUS, part_rows: int = PART_ROWS) -> DataFrame:
    """Edges ``u > v`` between node ids that connect all fingerprints within ``radius`` bits."""

    def join(table: pa.Table) -> pa.Table:
        fp, side = table.column("fp").to_numpy().view(np.uint64), table.column("side").to_numpy()
        node = table.column("node").to_numpy()
        order = np.lexsort((fp, side))
        fp, side, node = fp[order], side[order], node[order]
        if side[-1] == 0:
            links = trie_links(fp, None, radius)
        else:
            cut = int(np.searchsorted(side, 2))
            links = ((i, j + cut) for i, j in trie_links(fp[:cut], fp[cut:], radius))
        root = forest(len(fp), links)
        linked = root != np.arange(len(root))
        a, b = node[linked], node[root[linked]]
        return pa.table({"u": np.maximum(a, b), "v": np.minimum(a, b)})

    parts = parts_of(distinct, radius, part_rows)
    # a part of one row has no links: most parts end here, before any Python
    shared = parts.groupBy("part").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("part")
    return parts.join(shared, "part", "left_semi").groupBy("part").applyInArrow(join, "u long, v long").distinct()


@scratched("near-duplicates")
def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, part_rows: int = PART_ROWS) -> DataFrame:
    """``doc_id, fp, component_id`` for every row of ``docs``."""
    prints = stored(fingerprints(docs, id_col=id_col, text_col=text_col), "fingerprints")
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")), "distinct")
    linked = components(fingerprint_edges(distinct.select("fp", F.col("fp").alias("node")), radius=radius, part_rows=part_rows))
    # fingerprints with the one that stands for their component, and the smallest id among all of these
    headed = stored(distinct.join(linked.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", "n", F.coalesce("component", "fp").alias("head")), "headed")
    sizes = headed.agg(F.count(F.lit(1)), F.sum("n")).first()
    heads = headed.groupBy("head").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("size"))
    labels = lookup(headed.select("fp", "n", "head"), heads, "head", "size", sizes[0]).select("fp", "component_id", "n")
    return lookup(prints, labels, "fp", "n", sizes[1] or 0).select("doc_id", "fp", "component_id")
