"""Reconciliation of kept records with an answer key: one-to-one, greedily, volume by volume.

Pairs are made by joins: of one page first, then, of what that leaves, of one volume. Keys of one
caption are alike in all that scores, and so are records: they are paired as looks, each with the ids
that have it, so that copies make no pairs. Up to ``TASK_LOOKS`` scored pairs of looks of a page or volume go
to a task together, where the greedy choice is made; more are expanded into rows and worked down by joins first.
"""

from __future__ import annotations

import heapq
import itertools
import logging
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexmill.functions.text import match_key, match_tokens
from lexmill.operators.captions import can_reach, ratios, with_ratio
from lexmill.storage import scratched, stored

# Thresholds of captions on one page, in one volume, and of copies; the span.
PAGE_NAME, VOLUME_NAME, COPY_NAME = 0.35, 0.72, 0.7
FIRST_VOLUME, LAST_VOLUME = 2, 18
#: Pairs of rows, and of looks, that one task chooses from.
TASK_PAIRS, TASK_LOOKS = 200_000, 2_000_000

log = logging.getLogger(__name__)


def token_share(wanted: str, found: str) -> Column:
    """The share of the key's tokens that a record has, if the key has two or more, else 0."""
    return F.when(F.size(wanted) >= 2, F.size(F.array_intersect(wanted, found)) / F.size(wanted)).otherwise(F.lit(0.0))


def page_score(ratio: Column, wanted: str, found: str) -> Column:
    """How well a key and a record of one page agree."""
    return F.greatest(ratio, token_share(wanted, found))


def greedy(pairs: DataFrame, by: list[str]) -> DataFrame:
    """The pairs that are taken one after another, by ``rank``, each if both of its sides are still free; the pairs
    of one group are in one task."""

    def choose(rows: pd.DataFrame) -> pd.DataFrame:
        keys, records, taken = set(), set(), []
        for row in rows.sort_values("place", kind="stable").itertuples():
            if (row.volume, row.ord) not in keys and row.cluster_id not in records:
                keys.add((row.volume, row.ord))
                records.add(row.cluster_id)
                taken.append((row.volume, row.ord, row.cluster_id))
        return pd.DataFrame(taken, columns=["volume", "ord", "cluster_id"])

    place = F.row_number().over(Window.partitionBy(*by).orderBy("rank"))
    return pairs.withColumn("place", place).drop("rank").groupBy(*by).applyInPandas(choose, "volume int, ord long, cluster_id long")


def dominant(pairs: DataFrame) -> DataFrame:
    """The pairs that are the best left for both of their sides. A key or a record has one best pair
    each, so that however many pairs one of them is in, they meet as single rows."""
    of_key = pairs.groupBy("volume", "ord").agg(F.min("rank").alias("rank"))
    of_record = pairs.groupBy("cluster_id").agg(F.min("rank").alias("rank"))
    return of_key.join(of_record, "rank").select("volume", "ord", "cluster_id")


def one_to_one(pairs: DataFrame, by: list[str], *order: tuple[str, bool], task_pairs: int = TASK_PAIRS) -> DataFrame:
    """``volume, ord, cluster_id`` of the pairs that are taken one after another in ``order`` (names, and
    whether they ascend), each if both of its sides are still free. ``by`` names what pairs have in common
    that can get in each other's way.

    Groups of more than ``task_pairs`` are worked down in rounds: every pair that is the best left for both
    of its sides is taken, and all other pairs of these sides go. As no two pairs are of one rank,
    that takes the same pairs as going through them one by one. What is left of a group then fits
    into a task.
    """
    rank = F.struct(*[(F.col(n) if up else -F.col(n)).alias(n) for n, up in order], *[F.col(c) for c in ("ord", "cluster_id") if c not in dict(order)])
    left, found, rounds = stored(pairs.select(*dict.fromkeys([*by, "volume", "ord", "cluster_id"]), rank.alias("rank")), "pairs"), [], 0
    while True:
        large = left.groupBy(*by).agg(F.count("*").alias("n_")).where(F.col("n_") > task_pairs).drop("n_")
        if large.isEmpty():
            break
        rounds += 1
        taken = stored(dominant(left.join(large, by, "left_semi")), "dominant-pairs")
        found.append(taken)
        left = stored(left.join(taken, ["volume", "ord"], "left_anti").join(taken, "cluster_id", "left_anti"), "pairs")
    log.info("%d rounds before the rest went to tasks", rounds)
    return reduce(DataFrame.unionByName, found, greedy(left, by))


class Members:
    """The ids of each look, ascending; the first free one goes first, so what is left is a tail."""

    def __init__(self, rows: pd.DataFrame):
        self.ids = {who: list(ids) for who, ids in zip(rows["a"].tolist(), rows["members"], strict=True)}
        self.at = dict.fromkeys(self.ids, 0)

    def first(self, who: int) -> int | None:
        """The first free id of a look."""
        ids, at = self.ids[who], self.at[who]
        return ids[at] if at < len(ids) else None

    def lowest(self, heap: list[tuple[int, int]]) -> int | None:
        """The look with the lowest free id, of a heap of ids that were once first and their looks."""
        while heap:
            known, who = heap[0]
            now = self.first(who)
            if now == known:
                return who
            heapq.heapreplace(heap, (now, who)) if now is not None else heapq.heappop(heap)
        return None

    def take(self, who: int) -> int:
        self.at[who] += 1
        return self.ids[who][self.at[who] - 1]


def levels(pairs: pd.DataFrame, column: str) -> Iterator[pd.DataFrame]:
    """Rows of each value of a column, the largest first."""
    ordered = pairs.sort_values(column, ascending=False, kind="stable")
    ends = [0, *(ordered[column].to_numpy()[1:] != ordered[column].to_numpy()[:-1]).nonzero()[0] + 1, len(ordered)]
    return (ordered.iloc[i:j] for i, j in itertools.pairwise(ends))


def chosen(keys: Members, records: Members, pairs: pd.DataFrame, by_key: bool) -> Iterator[tuple[int, int]]:
    """``ord, cluster_id`` as ``one_to_one`` takes them from pairs of looks ``a, b, score``: in the order of scores, keys and
    records, or ``by_key`` in that of keys, scores and records."""
    free: dict[int, list[list[tuple[int, int]]]] = {}

    def give(heap: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
        """Keys of a heap in order, each the first free record of its best level; keys of a look without any are done."""
        while (a := keys.lowest(heap)) is not None:
            while free[a] and (b := records.lowest(free[a][-1])) is None:
                free[a].pop()
            if not free[a]:
                heapq.heappop(heap)
                continue
            yield keys.take(a), records.take(b)

    for level in levels(pairs, "score"):
        found: dict[int, list[tuple[int, int]]] = {}
        for a, b in zip(level["a"].tolist(), level["b"].tolist(), strict=True):
            if keys.first(a) is not None and (low := records.first(b)) is not None:
                found.setdefault(a, []).append((low, b))
        for a, heap in found.items():
            heapq.heapify(heap)
            free.setdefault(a, []).insert(0, heap)
        if not by_key:
            yield from give(sorted((keys.first(a), a) for a in found))
    if by_key:
        yield from give(sorted((keys.first(a), a) for a in free))


def one_to_one_looks(keys: DataFrame, records: DataFrame, pairs: DataFrame, by: list[str], by_key: bool, task_looks: int = TASK_LOOKS, task_pairs: int = TASK_PAIRS) -> DataFrame:
    """``one_to_one`` for looks: ``keys`` and ``records`` have columns ``by``, ``a`` or ``b``, the lowest id of a look, and
    ``members``, its ids in order; ``pairs`` has ``by, a, b, score``. A key is named by its ``ord``, a record by its ``cluster_id``.
    All three are stable on rereading."""
    volume = by[0]
    counts = pairs.groupBy(*by).agg(F.count("*").alias("n_"))
    large = stored(counts.where(F.col("n_") > task_looks).drop("n_"), "large-groups")
    small = counts.where(F.col("n_") <= task_looks).drop("n_")
    row = lambda df, kind, a, b, score, members: df.select(*by, F.lit(kind).alias("kind"), a.alias("a"), b.alias("b"), score.alias("score"), members.alias("members"))
    zero, none = F.lit(0).cast("long"), F.array().cast("array<bigint>")
    rows = [
        row(pairs, 0, F.col("a"), F.col("b"), F.col("score"), none), row(keys.join(pairs.select(*by, "a").distinct(), [*by, "a"], "left_semi"), 1, F.col("a"), zero, F.lit(0.0), F.col("members")),
        row(records.join(pairs.select(*by, "b").distinct(), [*by, "b"], "left_semi"), 2, F.col("b"), zero, F.lit(0.0), F.col("members")),
    ]

    def choose(rows: pd.DataFrame) -> pd.DataFrame:
        kind = rows["kind"]
        taken = list(chosen(Members(rows[kind == 1]), Members(rows[kind == 2]), rows[kind == 0], by_key))
        return pd.DataFrame({"volume": rows[volume].iloc[0], "ord": [k for k, _ in taken], "cluster_id": [r for _, r in taken]})

    found = reduce(DataFrame.unionByName, rows).join(small, by, "left_semi").groupBy(*by).applyInPandas(choose, "volume int, ord long, cluster_id long")
    if large.isEmpty():
        return found
    side = lambda df, name, to: df.select(*by, name, F.explode("members").alias(to))
    every = pairs.join(large, by, "left_semi").join(side(keys, "a", "ord"), [*by, "a"]).join(side(records, "b", "cluster_id"), [*by, "b"])
    order = (("ord", True), ("score", False)) if by_key else (("score", False), ("ord", True))
    return found.unionByName(one_to_one(every, by, *order, ("cluster_id", True), task_pairs=task_pairs))


def looks(rows: DataFrame, by: list[str], ident: str, name: str) -> DataFrame:
    """Rows alike in ``by`` as one: ``name``, the lowest id, and ``members``, all ids in order."""
    return rows.groupBy(*by).agg(F.min(ident).alias(name), F.sort_array(F.collect_list(ident)).alias("members"))


def numbered_looks(rows: DataFrame, by: list[str], caption: list[str], ident: str, name: str, number: str) -> tuple[DataFrame, DataFrame]:
    """Looks of rows alike in ``by`` and ``caption``, with a ``number`` in the caption's place, and the captions by number: pairs
    of looks are many, and of captions few."""
    found = stored(looks(rows, [*by, *caption], ident, name), f"{name}-looks")
    captions = stored(found.select(*caption).distinct().withColumn(number, F.monotonically_increasing_id()), f"{name}-captions")
    return stored(found.join(captions, caption).drop(*caption), f"{name}-numbered-looks"), captions


@scratched("outcomes")
def outcomes(key: DataFrame, kept: DataFrame) -> DataFrame:
    """``volume, kind, cluster_id, page, name`` of every row of ``key(us_volume, page, name, ord)`` and
    ``kept(cluster_id, us_volume, us_page, case_name)``.

    Keys are matched_key or missing; records matched, residual_duplicate or anomaly. The best pairs
    of a page go first, ties to the earlier key and the lower id; keys left over then take, in
    their order, the most similar free record of the volume. A record left over is a copy, if its
    page has a match or its caption is like a matched one's, else an anomaly. A key is named by its
    ``ord``, which a volume has once.
    """
    shape = lambda page, name: [
        F.col("us_volume").cast("int").alias("volume"), F.coalesce(F.col(page).cast("string"), F.lit("")).alias("page"),
        F.coalesce(name, F.lit("")).alias("name"), match_key(name).alias("match"), match_tokens(name).alias("tokens"),
    ]
    keys = stored(key.select(*shape("page", "name"), F.col("ord").cast("long").alias("ord")), "keys")
    records = stored(kept.select(*shape("us_page", "case_name"), F.col("cluster_id").cast("long").alias("cluster_id")), "records")
    wanted = keys.select("volume", "page", "ord", F.col("match").alias("key_match"), F.col("tokens").alias("key_tokens"))
    own = records.select("volume", "page", "cluster_id", "match", "tokens")

    page = ["volume", "page"]
    a, key_captions = numbered_looks(wanted, page, ["key_match", "key_tokens"], "ord", "a", "key_caption")
    b, captions = numbered_looks(own, page, ["match", "tokens"], "cluster_id", "b", "caption")
    paged = a.drop("members").join(b.drop("members"), page)
    asked = paged.select("key_caption", "caption").distinct().join(key_captions, "key_caption").join(captions, "caption")
    scored = ratios(asked, "key_match", "match").withColumn("ratio", F.when(F.col("ratio") >= PAGE_NAME, F.col("ratio")).otherwise(0.0))
    scored = stored(scored.select("key_caption", "caption", page_score(F.col("ratio"), "key_tokens", "tokens").alias("score")).where(F.col("score") >= PAGE_NAME), "caption-scores")
    paged = paged.join(scored, ["key_caption", "caption"]).select(*page, "a", "b", "score")
    first = stored(one_to_one_looks(a, b, stored(paged, "page-pairs"), page, False), "matched-on-page")

    left = wanted.join(first, ["volume", "ord"], "left_anti")
    free = own.join(first, "cluster_id", "left_anti")
    a, b = stored(looks(left, ["volume", "key_match"], "ord", "a"), "key-looks"), stored(looks(free, ["volume", "match"], "cluster_id", "b"), "record-looks")
    wide = a.drop("members").join(b.drop("members"), "volume").where(can_reach("key_match", "match", VOLUME_NAME))
    wide = with_ratio(wide, "key_match", "match", VOLUME_NAME).where(F.col("ratio") >= VOLUME_NAME).select("volume", "a", "b", F.col("ratio").alias("score"))
    second = one_to_one_looks(a, b, stored(wide, "volume-pairs"), ["volume"], True)
    taken = stored(first.unionByName(second), "matched")

    named = own.join(taken.select("cluster_id"), "cluster_id", "left_semi")
    pages = named.select("volume", "page").distinct()  # a match on a page has the key's page
    extra = records.join(taken.select("cluster_id"), "cluster_id", "left_anti")
    apart = extra.join(pages, ["volume", "page"], "left_anti").select("volume", "match").distinct()
    like = apart.join(named.select("volume", F.col("match").alias("other")).distinct(), "volume").where(can_reach("match", "other", COPY_NAME))
    like = with_ratio(like, "match", "other", COPY_NAME).where(F.col("ratio") >= COPY_NAME).select("volume", "match").distinct()
    copies = extra.join(pages, ["volume", "page"], "left_semi").unionByName(extra.join(pages, ["volume", "page"], "left_anti").join(like, ["volume", "match"], "left_semi").select(*extra.columns))
    anomalies = extra.join(copies.select("cluster_id"), "cluster_id", "left_anti")

    nobody = F.lit(None).cast("long").alias("cluster_id")
    rows = lambda df, kind, who: df.select("volume", F.lit(kind).alias("kind"), who, "page", "name")
    met = taken.select("volume", "ord")
    parts = [
        rows(keys.join(met, ["volume", "ord"], "left_semi"), "matched_key", nobody), rows(keys.join(met, ["volume", "ord"], "left_anti"), "missing", nobody),
        rows(records.join(taken.select("cluster_id"), "cluster_id", "left_semi"), "matched", F.col("cluster_id")),
        rows(copies, "residual_duplicate", F.col("cluster_id")), rows(anomalies, "anomaly", F.col("cluster_id")),
    ]
    return reduce(DataFrame.unionByName, parts)


def reconcile(key: DataFrame, kept: DataFrame, first: int = FIRST_VOLUME, last: int = LAST_VOLUME) -> tuple[DataFrame, DataFrame]:
    """A row per volume of the span, also of empty ones, and the rows that didn't match."""
    span = F.col("us_volume").between(first, last)
    found = outcomes(key.where(span), kept.where(span))
    counts = found.groupBy("volume").agg(
        F.count_if(F.col("cluster_id").isNotNull()).alias("n_keep"), F.count_if(F.col("cluster_id").isNull()).alias("n_reference"), F.count_if(F.col("kind") == "matched").alias("n_matched"),
        F.count_if(F.col("kind") == "missing").alias("n_missing"), F.count_if(F.col("kind").isin("residual_duplicate", "anomaly")).alias("n_extra"),
    )
    volumes = key.sparkSession.range(first, last + 1).select(F.col("id").cast("int").alias("volume"))
    names = ["n_keep", "n_reference", "n_matched", "n_missing", "n_extra"]
    summary = volumes.join(counts, "volume", "left").select("volume", *[F.coalesce(n, F.lit(0)).alias(n) for n in names])
    return summary, found.where(~F.col("kind").isin("matched", "matched_key"))


# Columns of the report: heading, and the value of a volume's row.
COLUMNS = (
    ("volume", lambda r: r["volume"]), ("kept", lambda r: r["n_keep"]), ("key", lambda r: r["n_reference"]), ("matched", lambda r: r["n_matched"]),
    ("missing", lambda r: r["n_missing"]), ("extra", lambda r: r["n_extra"]), ("agrees", lambda r: "yes" if r["n_missing"] + r["n_extra"] == 0 else "no"),
)
COUNTED = ("n_keep", "n_reference", "n_matched", "n_missing", "n_extra")


def as_table(cells: list[list[str]]) -> list[str]:
    """Rows of cells as a table of pipes, the first row its head."""
    widths = [max(map(len, column)) for column in zip(*cells, strict=True)]
    lines = ["| " + " | ".join(x.rjust(w) for x, w in zip(row, widths, strict=True)) + " |" for row in cells]
    return [lines[0], "|" + "|".join("-" * (w + 1) + ":" for w in widths) + "|", *lines[1:]]


def format_report(summary: DataFrame, detail: DataFrame) -> Iterator[str]:
    """The reconciliation as lines: a table of volumes and their sum, then a line for each row that
    didn't match, which are read one by one and so may be many."""
    rows = [r.asDict() for r in summary.orderBy("volume").collect()]
    rows.append({"volume": "all"} | {k: sum(r[k] for r in rows) for k in COUNTED})
    yield from as_table([[name for name, _ in COLUMNS], *[[str(value(r)) for _, value in COLUMNS] for r in rows]])
    shown = F.concat_ws(
        " ", F.concat(F.lit("volume "), "volume", F.lit(":")), F.regexp_replace("kind", "_", " "), F.concat(F.lit("on page "), "page"), F.concat(F.lit("id "), "cluster_id"), F.concat(F.lit("“"), "name", F.lit("”"))
    )
    for row in detail.orderBy("volume", F.desc(F.col("kind") == "missing"), "cluster_id", "page", "name").select(shown).toLocalIterator():
        yield row[0]
