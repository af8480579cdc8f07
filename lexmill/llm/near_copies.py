"""Groups of near copies: texts whose sets of five-word shingles have a Jaccard similarity of 0.8.

Candidate pairs come from the binary-trie self-join of ``simhash``, which links what differs least,
by fingerprints of the same shingles, and from prefix filters: near copies of 0.8 differ in up to ten
bits or more, a radius at which a trie prunes nothing, while the filters lose no pair.
Sets that similar have at least ``need`` = ceil(0.8 * n) shingles in common, n being
the size of either; so, whatever order all shingles are put in, they share k of the first
n - need + k of both. That is used twice: in order of hashes and with k = n / 10 it finds the sets
that share so many with other sets at all; among those, with k = 1, rarest first and without shingles
of one set alone, it finds the candidate pairs, which are then compared exactly.

Equal sets fold into one before pairs are made. Of each shingle's sets one is compared with the
others first; only sets that this leaves in different groups are then compared with each other, so
a large group of copies doesn't make all its pairs.

Defined results: words are folded by ASCII case; a text of fewer than five words is one shingle;
texts without words are copies of each other; repeated rows are copies, and unrelated texts of one
id aren't; rows without an id have no group and aren't dropped; an empty table gives an empty table;
columns of any other name are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexmill.operators.components import components
from lexmill.operators.keyed import lookup
from lexmill.storage import scratched

from .shared import packed, stored, trimmed
from .simhash import bit_counts, fingerprint_edges, majority, shingle_hashes

SHINGLE_WORDS = 5
#: Differing bits up to which the trie links fingerprints.
RADIUS = 3
#: The least similarity, as a fraction of whole numbers: bounds stay exact.
PART, WHOLE = 4, 5
#: The k of the first filter is a set's size over this.
SHARED_OVER = 10
#: Texts whose sets a worker holds at once.
ROWS_AT_ONCE = 500


def shingle_set(text: bytes) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of a UTF-8 text, ASCII letters folded."""
    return np.unique(np.concatenate([np.zeros(0, np.uint64), *shingle_hashes(text, SHINGLE_WORDS)]).view(np.int64))


def prefix_size(n: int) -> int:
    return n - -(-PART * n // WHOLE) - (-n // SHARED_OVER)


def shingled(docs: DataFrame, whole: bool) -> DataFrame:
    """``doc_id, mark, set_id, n, fp, h`` of ``doc_id, mark, text``: a text's shingle set by a hash of
    it, its size and fingerprint, and its members, all of them or those that come first."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (x.slice(i, ROWS_AT_ONCE) for x in batches for i in range(0, x.num_rows, ROWS_AT_ONCE)):
            sets = [shingle_set(x.as_py() or b"") for x in batch.column(2).cast(pa.binary())]
            names = np.fromiter((xxhash.xxh3_64_intdigest(h.tobytes()) for h in sets), np.uint64, len(sets))
            prints = np.fromiter((majority(bit_counts(h.view(np.uint64)), len(h)) for h in sets), np.uint64, len(sets))
            sizes = [len(h) for h in sets]
            shown = sets if whole else [h[: prefix_size(len(h))] for h in sets]
            ends = np.cumsum([0, *map(len, shown)])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *shown])))
            longs = [pa.array(x) for x in (names.view(np.int64), np.array(sizes, np.int64), prints.view(np.int64))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *longs, lists], ["doc_id", "mark", "set_id", "n", "fp", "h"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(trimmed(compute), f"doc_id {kind}, mark long, set_id long, n long, fp long, h array<long>")


def can_match(a: str, b: str) -> Column:
    """Whether two sets can be similar whose first shingle in common is that of these probes: by
    their sizes, and by how many common shingles both still have from there on."""
    n, m, rest = F.col(f"{a}n"), F.col(f"{b}n"), F.least(F.col(f"{a}kept") - F.col(f"{a}r"), F.col(f"{b}kept") - F.col(f"{b}r")) + 1
    return (WHOLE * F.least(n, m) >= PART * F.greatest(n, m)) & ((WHOLE + PART) * rest >= PART * (n + m))


def similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the pairs ``u, v`` whose sets are similar, by comparing them whole."""
    both = pairs.join(sets.select(F.col("set_id").alias("u"), F.col("h").alias("x")), "u").join(sets.select(F.col("set_id").alias("v"), F.col("h").alias("y")), "v")
    shared = F.size(F.array_intersect("x", "y"))
    return both.withColumn("shared", shared).where(WHOLE * F.col("shared") >= PART * (F.size("x") + F.size("y") - F.col("shared"))).select("u", "v")


def sharing(short: DataFrame) -> DataFrame:
    """``set_id, n, fp, node`` of sets that share enough of their first shingles with other sets; a
    node is the id and mark of one of a set's texts."""
    rows = short.select("set_id", F.explode("h").alias("s"))
    shared = stored(rows.groupBy("s").agg(F.min("set_id").alias("low"), F.max("set_id").alias("high")).where("low < high").select("s"), "shared-shingles")
    met = rows.join(shared.hint("merge"), "s", "left_semi").groupBy("set_id").agg(F.count(F.lit(1)).alias("shared"))
    known = short.groupBy("set_id").agg(F.min(F.struct("doc_id", "mark")).alias("node"), F.first("n").alias("n"), F.first("fp").alias("fp"), F.count(F.lit(1)).alias("copies"))
    # the least k of a pair is that of the smallest set which is still similar
    least = F.expr(f"(({PART} * n + {WHOLE - 1}) div {WHOLE} + {SHARED_OVER - 1}) div {SHARED_OVER}")
    return known.join(met, "set_id").where(F.col("shared") >= least * F.col("copies")).select("set_id", "n", "fp", "node")


def pair(a: str, b: str) -> list[Column]:
    return [F.greatest(a, b).alias("u"), F.least(a, b).alias("v")]


def trie_pairs(sets: DataFrame) -> DataFrame:
    """Pairs ``u > v`` of sets whose fingerprints the trie links, or are equal."""
    prints = stored(sets.groupBy("fp").agg(F.min("set_id").alias("node"), F.count(F.lit(1)).alias("copies")), "prints")
    linked = fingerprint_edges(prints.select("fp", "node"), radius=RADIUS)
    same = sets.select("fp", "set_id").join(prints.where("copies > 1"), "fp").where("set_id <> node").select(*pair("set_id", "node"))
    return linked.union(same)


def probes(sets: DataFrame) -> DataFrame:
    """``set_id, n, kept, r, s``: the rarest shingles of each set, as many as similar sets need to meet.

    Shingles of one set alone are left out; ``kept`` counts the others and ``r`` ranks them.
    """
    long = sets.select("set_id", "n", F.explode("h").alias("s"))
    common = long.groupBy("s").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    own = Window.partitionBy("set_id")
    ranked = long.join(common, "s").withColumn("kept", F.count(F.lit(1)).over(own)).withColumn("r", F.row_number().over(own.orderBy("df", "s")))
    need = F.expr(f"({PART} * n + {WHOLE - 1}) div {WHOLE}")
    # no row is left of a set whose common shingles are too few
    return ranked.where(F.col("r") <= F.col("kept") - need + 1).select("set_id", "n", "kept", "r", "s")


def with_group(rows: DataFrame, label: DataFrame) -> DataFrame:
    """``rows`` with ``c``, the group of the set; a set without links is a group of its own."""
    named = label.select(F.col("node").alias("set_id"), "component")
    return rows.join(named, "set_id", "left").withColumn("c", F.coalesce("component", "set_id")).drop("component")


def set_edges(sets: DataFrame) -> DataFrame:
    """Pairs ``u > v`` of similar sets that connect all similar sets."""
    found = stored(probes(sets), "probes")
    # first one set for each shingle, that of the fewest shingles of its own, with all others
    first = found.groupBy("s").agg(F.max_by(F.struct("set_id", "n", "kept", "r"), F.struct(F.col("kept") / F.col("n"), "set_id")).alias("p"))
    star = found.join(first, "s").where((F.col("set_id") != F.col("p.set_id")) & can_match("", "p.")).select(*pair("set_id", "p.set_id"))
    edges = stored(similar(star.union(trie_pairs(sets)).distinct(), sets), "first-edges")
    # then sets that this has left apart, with each other
    rows = stored(with_group(found, components(edges)), "labelled-probes")
    apart = rows.groupBy("s").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low < high").select("s")
    rows = stored(rows.join(apart, "s", "left_semi"), "apart")
    both = rows.alias("a").join(rows.alias("b"), (F.col("a.s") == F.col("b.s")) & (F.col("a.c") < F.col("b.c")) & can_match("a.", "b."))
    rest = both.select(*pair("a.set_id", "b.set_id")).distinct()
    return edges.unionByName(stored(similar(rest, sets), "other-edges"))


@scratched("near-copies")
def near_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, mark, group_id`` for every row of ``docs`` with an id; ``mark`` is a hash of the text, a
    group is named by one of its sets."""
    texts = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("mark"), F.col(text_col).alias("text"))
    short = stored(shingled(texts, whole=False), "first-shingles")
    met = stored(sharing(short), "sharing")
    ones = texts.join(met.select("node.doc_id", "node.mark").hint("merge"), ["doc_id", "mark"], "left_semi")
    # rows that repeat, and so give one set several times, are folded
    sets = stored(shingled(ones, whole=True).groupBy("set_id").agg(F.first("n").alias("n"), F.first("fp").alias("fp"), F.first("h").alias("h")), "whole-sets")
    linked = components(set_edges(sets))
    named = stored(with_group(short.groupBy("set_id").agg(F.count(F.lit(1)).alias("copies")), linked), "groups")
    return lookup(short.select("doc_id", "mark", "set_id"), named, "set_id", "copies", short.count()).select("doc_id", "mark", F.col("c").alias("group_id"))


def without_near_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, but one of each group alone: that of the smallest id and,
    if texts of one id differ, of the smallest hash of its text."""
    found = near_copies(docs, id_col=id_col, text_col=text_col)
    rows = stored(found.groupBy("doc_id", "mark").agg(F.min("group_id").alias("group_id"), F.count(F.lit(1)).alias("rows")), "marked")
    heads = rows.groupBy("group_id").agg(F.min(F.struct("doc_id", "mark")).alias("head"), F.count(F.lit(1)).alias("size"))
    own = F.struct("doc_id", "mark") == F.col("head")
    ruled = lookup(rows, heads, "group_id", "size", rows.count()).select("doc_id", "mark", own.alias("first"), "rows")
    # all rows to take out: copies, and first rows that repeat, of which one comes back
    out = stored(ruled.where("NOT first OR rows > 1").select("doc_id", "mark", "first"), "taken-out")
    every = packed(docs).select("row", F.col(f"row.`{id_col}`").alias("doc_id"), F.xxhash64(f"row.`{text_col}`").alias("mark"))
    # both sides grow with the corpus, so the plan is a merge join at every size
    kept = every.join(out.select("doc_id", "mark").hint("merge"), ["doc_id", "mark"], "left_anti").select("row")
    again = out.where("first").select("doc_id", "mark")
    if not again.isEmpty():
        back = every.join(again, ["doc_id", "mark"], "left_semi").groupBy("doc_id", "mark")
        kept = kept.unionByName(back.agg(F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row")).select("row"))
    return kept.select("row.*")
