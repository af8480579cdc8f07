"""Mixing sources to target weights by entropy balancing, in DataFrame functions alone.

The size of a document is its words. Sources in order of their names, null last, have the ``weights`` in
turn; together they are to give ``share`` times the words there are, no source more than ``most``
times its own, and what a source can't give goes to the others by weight.

Of all rates that give each source its target and take no document more than ``most`` times, entropy
balancing takes those nearest to one in relative entropy: ``min(most, exp(tilt * size))``, where a
source's tilt solves the convex dual, whose slope is the words taken less the target. Newton's method
finds all tilts at the same time. Rates depend on source and size alone, so its rounds add up counts by
source and size, not documents, in decimals, whose sums don't depend on their order; a step that
leaves the bracket that earlier rounds gave is replaced by its middle.

Rates become copies by a draw that a hash of id and text fixes: a document has its whole copies, and
one more if its draw less the rest of its rate is below its source's threshold. The threshold that
gives the target is found by its digits, from sums by digit: the documents that share the first one are
few enough to be stored for the others. The document at the threshold gives a part of
its last copy, so that a source's words are its target, rounded; rows repeated exactly share that part and
miss the target by less than a word each. No row of documents goes to the driver, and a source of
any size is never in one task.

Defined results: a null text has no words; documents without words are taken with none; a null source is a
source, the last; a null id is an id; extra columns are ignored, whatever their names; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexmill.operators.keyed import lookup
from lexmill.storage import scratched

from .shared import named, stored

WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2
WORD = r"[^\x20\x09-\x0D]+"
#: Words that may be missing of a target's, as a part of it, when Newton's method ends: the threshold makes up for them.
NEAR = 1e-7
ROUNDS = 200
#: Bits of a draw, and of a digit of it.
DRAW_BITS, DIGIT_BITS = 62, 16
EXACT = "decimal(38,6)"


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """``doc_id``, ``key``, ``size`` and ``draw`` of each document; the key is empty for a null source."""
    rows = named(docs, doc_id=id_col, text=text_col, source=source_col)
    key = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    draw = F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 64 - DRAW_BITS)
    return rows.select("doc_id", key.alias("key"), size.alias("size"), draw.alias("draw"))


def weighted(sources: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """Adds ``weight``, by a source's place among all, counted in each part of a sorted table."""
    order = [F.col("key") == "", F.col("key")]
    parts = stored(sources.orderBy(*order).withColumn("part", F.spark_partition_id()), "sources")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each part
    starts = parts.groupBy("part").agg(F.count("*").alias("rows")).select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    place = F.col("start") + F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights)).cast("int") + 1)
    return parts.join(F.broadcast(starts), "part").withColumn("weight", weight).drop("part", "start")


def with_targets(sources: DataFrame, share: float, most: int) -> DataFrame:
    """Adds ``target``: the weight times a level common to all, or ``most`` times the source's size if
    that is less. The level rises until the sources below their limit take what the others leave."""
    limit = most * F.col("source_size")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, found = -1.0, 0.0
    while found > level:
        level = found
        full = limit <= F.col("weight") * level
        fixed, opened = sources.agg(F.sum(F.when(full, limit)), F.sum(F.when(~full, F.col("weight")))).first()
        found = (share * total - (fixed or 0)) / opened if opened else level
    return sources.withColumn("target", F.least(limit.cast("double"), F.col("weight") * F.lit(level)))


def rate(most: int) -> Column:
    """The tilted rate of a document."""
    return F.when(F.col("target") >= most * F.col("source_size"), F.lit(float(most))).otherwise(F.least(F.lit(float(most)), F.exp(F.col("tilt") * F.col("size") / F.col("scale"))))


def newton(cells: DataFrame, state: DataFrame, most: int) -> DataFrame:
    """One step for every source that isn't balanced yet."""
    words = F.col("n") * F.col("size") * F.col("rate")
    slope = F.when(F.col("rate") < most, words * F.col("size") / F.col("scale")).otherwise(0.0)
    sums = (
        cells.join(state.where(~F.col("done")).select("key", "target", "source_size", "scale", "tilt"), "key").withColumn("rate", rate(most))
        .groupBy("key").agg(F.sum(words.cast(EXACT)).cast("double").alias("have"), F.sum(slope.cast(EXACT)).cast("double").alias("slope"))
    )
    low = F.when(F.col("have") < F.col("target"), F.col("tilt")).otherwise(F.col("low"))
    high = F.when(F.col("have") < F.col("target"), F.col("high")).otherwise(F.col("tilt"))
    step = F.when(F.col("slope") > 0, F.col("tilt") + (F.col("target") - F.col("have")) / F.col("slope"))
    inside = F.coalesce(F.col("step") > F.col("low"), F.lit(True)) & F.coalesce(F.col("step") < F.col("high"), F.lit(True)) & F.col("step").isNotNull()
    other = F.when(F.col("high").isNull(), 2 * F.col("low") + 1).when(F.col("low").isNull(), 2 * F.col("high") - 1).otherwise((F.col("low") + F.col("high")) / 2)
    near = F.abs(F.col("have") - F.col("target")) <= NEAR * F.col("target")
    stuck = F.coalesce((other <= F.col("low")) | (other >= F.col("high")), F.lit(False))  # no number lies between
    moved = (
        state.where(~F.col("done")).join(sums, "key").withColumns({"low": low, "high": high, "step": step, "near": near})
        .withColumn("next", F.when(F.col("near"), F.col("tilt")).when(inside, F.col("step")).otherwise(other))
        .withColumns({"done": F.col("near") | stuck, "tilt": F.col("next")}).select(*state.columns)
    )
    return state.where("done").unionByName(moved)


def balanced(docs: DataFrame, sources: DataFrame, most: int) -> DataFrame:
    """Adds ``scale`` and ``tilt``, by which a document's rate follows from its size."""
    cells = stored(docs.where("size > 0").groupBy("key", "size").agg(F.count("*").alias("n")), "cells")
    scale = cells.groupBy("key").agg((F.sum((F.col("n") * F.col("size")).cast("decimal(20,0)") * F.col("size")) / F.sum(F.col("n") * F.col("size"))).cast("double").alias("scale"))
    state = sources.join(scale, "key", "left").withColumns({
        "scale": F.coalesce("scale", F.lit(1.0)), "tilt": F.lit(0.0), "low": F.lit(None).cast("double"), "high": F.lit(None).cast("double"),
        "done": (F.col("target") >= most * F.col("source_size")),
    })
    state = stored(state, "tilts")
    for _ in range(ROUNDS):
        if state.where(~F.col("done")).isEmpty():
            break
        state = stored(newton(cells, state, most), "tilts")
    return state.drop("low", "high", "done")


def digit(i: int) -> Column:
    return F.shiftright("place", DIGIT_BITS * (3 - i)).bitwiseAND((1 << DIGIT_BITS) - 1)


def chosen(sums: DataFrame) -> DataFrame:
    """Of sums of ``words`` by key and digit, the digit in which the ``missing`` words end, with what is missing
    when it begins. A source has at most one row for each value of a digit."""
    upto = F.sum("words").over(Window.partitionBy("key").orderBy("digit"))
    return sums.withColumn("upto", upto).where((F.col("upto") > F.col("missing")) & (F.col("upto") - F.col("words") <= F.col("missing"))).select("key", "digit", (F.col("missing") - F.col("upto") + F.col("words")).alias("missing"), "words")


def thresholds(rated: DataFrame, sources: DataFrame, total: int) -> DataFrame:
    """``key``, ``threshold`` (a place among draws), and of the copies there the ``words`` and how many of them are
    ``missing``. Sources without a threshold take all further copies."""
    wanted = rated.groupBy("key").agg(F.sum(F.col("copies") * F.col("size")).alias("given")).join(sources.select("key", "target"), "key")
    wanted = wanted.select("key", F.greatest(F.round("target").cast("long") - F.col("given"), F.lit(0)).alias("missing"))
    left, at = rated.where("size > 0").select("key", "size", "place"), F.lit(0).cast("long")
    found = None
    for i in range(4):
        sums = left.groupBy("key", digit(i).alias("digit")).agg(F.sum("size").alias("words"))
        found = stored(chosen(sums.join(wanted, "key")), "digits")
        wanted = found.select("key", "missing")
        here = found.select("key", F.col("digit").alias("here"))
        # by the first digit the rows are all there are, after it those with the first digits of a threshold
        left = lookup(left, here.join(sources.select("key", "rows"), "key"), "key", "rows", total) if i == 0 else left.join(here, "key")
        left = left.where(digit(i) == F.col("here")).drop("here")
        if i == 0:
            left = stored(left, "around-thresholds")
        at = left.groupBy("key").agg(F.first("place").alias("threshold"))
    return found.join(at, "key").select("key", "threshold", "missing", "words")


@scratched("mixture")
def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``id_col``, ``size``, ``source_size``, ``target`` and ``taken`` (words) of every document."""
    rows = stored(sized(docs, id_col, text_col, source_col), "sizes")
    total = rows.count()
    sources = rows.groupBy("key").agg(F.count("*").alias("rows"), F.sum("size").alias("source_size"))
    sources = stored(with_targets(weighted(sources, weights), share, most), "targets")
    sources = stored(balanced(rows, sources, most), "balanced")
    whole = F.least(F.floor(rate(most)), F.lit(most - 1)).cast("long")
    place = (F.col("draw") + F.lit(1 << DRAW_BITS)) - ((F.col("rate") - F.col("copies")) * float(1 << DRAW_BITS)).cast("long")
    rated = lookup(rows, sources, "key", "rows", total).withColumns({"rate": rate(most), "copies": whole}).withColumn("place", place)
    rated = stored(rated.select("doc_id", "key", "size", "source_size", "target", "copies", "place"), "rates")
    ends = stored(sources.select("key", "rows").join(thresholds(rated, sources, total), "key", "left"), "thresholds")
    part = F.expr("(CAST(size AS DECIMAL(19,0)) * missing) DIV words")
    more = F.when(F.col("threshold").isNull() | (F.col("place") < F.col("threshold")), F.col("size")).when(F.col("place") == F.col("threshold"), part).otherwise(0)
    found = lookup(rated, ends, "key", "rows", total)
    return found.select(F.col("doc_id").alias(id_col), "size", "source_size", "target", (F.col("copies") * F.col("size") + more).cast("long").alias("taken"))
