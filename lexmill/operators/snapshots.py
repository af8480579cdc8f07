"""Checksum ledgers, and differences between two readings of the same records."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions.records import VOLATILE_FIELDS
from lexmill.storage import scratched, stored

#: Bits by which a level of a hash tree is wider than the one above, and records in a leaf, about.
FANOUT_BITS, LEAF_ROWS = 8, 4


def checksums(files: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """``path, sha256`` of each file's bytes."""
    return files.select(F.col(path).alias("path"), F.sha2(F.col(content), 256).alias("sha256"))


def verify(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """``path, reason`` where files and ledger disagree; empty if all is well."""
    both = ledger.select("path", F.col("sha256").alias("want")).join(files.select("path", F.col("sha256").alias("got")), "path", "full_outer")
    reason = F.when(F.col("got").isNull(), "missing").when(F.col("want").isNull(), "not in ledger").when(F.col("got") != F.col("want"), "hash mismatch")
    return both.select("path", reason.alias("reason")).where("reason IS NOT NULL")


def stable(record: Column | str, volatile: tuple[str, ...] = VOLATILE_FIELDS) -> Column:
    """A record's top-level fields that a server doesn't set anew, as a map of JSON values."""
    fields = F.from_json(record, "map<string,string>")
    return F.map_filter(fields, lambda k, v: ~k.isin(*volatile))


def canonical(fields: Column) -> Column:
    return F.array_sort(F.map_entries(fields))


def leaves(snapshot: DataFrame, key: str, record: str, levels: int) -> DataFrame:
    """``node, digest, n``: sums of hashes of the records whose keys hash into each leaf of a tree."""
    digest = F.sum(F.xxhash64(key, F.col(record).isNull(), record).cast("decimal(38,0)"))
    return snapshot.where(F.col(key).isNotNull()).groupBy(leaf_of(key, levels).alias("node")).agg(digest.alias("digest"), F.count("*").alias("n"))


def leaf_of(key: str, levels: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key), 64 - FANOUT_BITS * levels)


def differing(a: DataFrame, b: DataFrame, levels: int) -> DataFrame | None:
    """The leaves in which two trees differ, or None. From the top level down only what lies below
    nodes that differ is compared: sums of a node are those of the nodes below it."""
    below = None
    for level in range(1, levels + 1):
        up = FANOUT_BITS * (levels - level)
        rolled = [x.groupBy(F.shiftrightunsigned("node", up).alias("node")).agg(F.sum("digest").alias("digest"), F.sum("n").alias("n")) if up else x for x in (a, b)]
        if below is not None:
            rolled = [x.withColumn("above", F.shiftrightunsigned("node", FANOUT_BITS)).join(below.withColumnRenamed("node", "above"), "above", "left_semi").drop("above") for x in rolled]
        # a node of one snapshot alone stays alone, and so does one whose sums differ
        alone = rolled[0].unionByName(rolled[1]).groupBy("node", "digest", "n").agg(F.count("*").alias("both")).where("both = 1")
        below = stored(alone.select("node").distinct(), "differing")
        if below.isEmpty():
            return None
    return below


@scratched("snapshot-diff")
def diff(a: DataFrame, b: DataFrame, key: str = "id", record: str = "record", volatile: tuple[str, ...] = VOLATILE_FIELDS) -> DataFrame:
    """``key, status`` of records that differ: only_a, only_b, substantive or volatile.

    Records are JSON texts; the order of their fields doesn't matter. A snapshot has a key once; rows without a key
    are in one snapshot alone. Each snapshot is read once for the leaves of a hash tree, with about
    ``LEAF_ROWS`` records each; records are only joined in leaves that differ.
    """
    total = max(a.count(), b.count())
    levels = max(1, min(7, math.ceil(math.log2(max(2, total / LEAF_ROWS)) / FANOUT_BITS)))
    left, right = (x.select(key, F.col(record).alias(n)) for x, n in ((a, "a_"), (b, "b_")))
    apart = differing(stored(leaves(left, key, "a_", levels), "leaves"), stored(leaves(right, key, "b_", levels), "leaves"), levels)
    if apart is None:
        left, right = (x.where(F.col(key).isNull()) for x in (left, right))
    else:
        left, right = (changed(x, apart, key, levels) for x in (left, right))
    both = left.join(right, key, "full_outer")
    whole = lambda c: canonical(F.from_json(c, "map<string,string>"))
    status = (
        F.when(F.col("b_").isNull(), "only_a").when(F.col("a_").isNull(), "only_b")
        .when(canonical(stable("a_", volatile)) != canonical(stable("b_", volatile)), "substantive").when(whole("a_") != whole("b_"), "volatile")
    )
    return both.select(key, status.alias("status")).where("status IS NOT NULL")


def changed(snapshot: DataFrame, apart: DataFrame, key: str, levels: int) -> DataFrame:
    """The records in leaves that differ, and those without a key."""
    keyed = snapshot.where(F.col(key).isNotNull()).withColumn("node", leaf_of(key, levels)).join(apart, "node", "left_semi").drop("node")
    return keyed.unionByName(snapshot.where(F.col(key).isNull()))
