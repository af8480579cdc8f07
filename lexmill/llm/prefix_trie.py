"""The trie of conversations' prefixes, with rollups over subtrees, from succinct tries of its parts.

A conversation is rebuilt from the first turns of its group's first conversation and its own later
turns (``rebuilt``). Two conversations share a node of depth d if their first d rebuilt turns have the
same roles and texts; turns are compared by 128-bit hashes. A node goes by its depth and the smallest
conversation through it.

No conversation is gathered in one place, however long it is. Positions and prefixes are running
sums and running exclusive ors over a table sorted by conversation and turn (``running``): each part
of it sums by itself and takes over what the parts before it leave, one row each. A node is then a
depth with a prefix hash, and counting members is one aggregation.

Conversations with equal turns fold into the smallest of them, with their number. Beyond the nodes
that different ones share, each is a tail, whose rollups follow from its running sums. Only
the shared nodes need a trie: each conversation's are a path of node labels. Paths below the same
node meet in one shard, at the first node that has at most ``SHARD_TURNS`` turns below it. numpy turns
the paths of a batch of shards into a trie level by level, kept as a LOUDS bitvector (for each node
in level order a one for each child, then a zero) and an array of labels: the parent of the j-th one
is the number of zeros before it. Rollups go up from the deepest level by ``np.add.at``. The heavy upper
nodes are in the tries of many shards, with what each shard gives them; they are merged by an
aggregation of their own.

Digests of the conversations that end in a node are of one byte sequence, which one task has to see
in order: ids are sorted and joined into texts of a batch each where they lie, and only these are
streamed.

Defined results: rows without a conversation id are left out; a null turn comes first; rows of one
turn are ordered by the hashes of role and text, and repeated rows are turns of their own; a null role or text is
empty; ``%`` keeps the sign of a negative id; extra columns are ignored, whatever their names; an empty
table has no nodes.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.operators.keyed import lookup
from lexmill.storage import scratched

from .shared import named, stored, trimmed

#: Conversations of a group share their first turns: up to ``HEADS - 1`` of them.
GROUP, HEADS = 5, 9
#: Turns below the top of a shard at most.
SHARD_TURNS = 200_000
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends string, heavy boolean"
NOBODY = hashlib.sha256(b"").hexdigest()


def running(rows: DataFrame, order: list[str], sums: dict[str, str], xors: dict[str, str], label: str) -> DataFrame:
    """Adds running sums and exclusive ors of columns over the rows of each ``conv_id``, in ``order``:
    ``{new: old}``. ``rows`` is read twice, and has ``conv_id`` and the columns of ``order``."""
    new, old = [*sums, *xors], [*sums.values(), *xors.values()]
    kinds = [np.add] * len(sums) + [np.bitwise_xor] * len(xors)
    tied = rows.withColumn("tie", F.monotonically_increasing_id())  # equal rows needn't lie together
    dealt = tied.repartitionByRange("conv_id", *order, "tie").sortWithinPartitions("conv_id", *order, "tie").drop("tie")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, left, seen = None, [0] * len(new), 0
        part = TaskContext.get().partitionId()
        for batch in batches:
            n = len(batch)
            if not n:
                continue
            conv = batch["conv_id"].to_numpy(zero_copy_only=False)
            begin = np.flatnonzero(np.r_[True, conv[1:] != conv[:-1]])
            group, found = np.repeat(np.arange(len(begin)), np.diff(np.r_[begin, n])), []
            for i, (name, kind) in enumerate(zip(old, kinds)):
                total = kind.accumulate(batch[name].to_numpy(zero_copy_only=False).astype(np.int64))
                before = np.r_[0, total][begin]
                if conv[0] == last:
                    before[0] = before[0] - left[i] if kind is np.add else before[0] ^ left[i]
                total = total - before[group] if kind is np.add else total ^ before[group]
                left[i] = int(total[-1])
                found.append(pa.array(total))
            last = conv[-1]
            place = [pa.array(np.full(n, part)), pa.array(np.arange(seen, seen + n))]
            seen += n
            yield pa.RecordBatch.from_arrays([*batch.columns, *found, *place], names=[*batch.schema.names, *new, "in_part", "at"])

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema], *[f"`{c}` long" for c in [*new, "in_part", "at"]]])
    found = stored(dealt.mapInArrow(trimmed(step), schema), label)
    ends = found.groupBy("in_part").agg(F.min_by("conv_id", "at").alias("first"), F.max_by(F.struct("conv_id", *new), "at").alias("last")).orderBy("in_part").collect()
    carried, conv, left = [], None, [0] * len(new)
    for r in ends:  # one row for each part of the sorted table
        goes_on = conv is not None and r["first"] == conv
        if goes_on:
            carried.append((r.in_part, conv, *left))
        stays = goes_on and r["last"].conv_id == conv
        left = [(r["last"][c] if not stays else r["last"][c] + x if k is np.add else r["last"][c] ^ x) for c, x, k in zip(new, left, kinds)]
        conv = r["last"].conv_id
    taken = rows.sparkSession.createDataFrame(carried, ", ".join(["in_part long", "conv_id long", *[f"`+{c}` long" for c in new]]))
    both = found.join(F.broadcast(taken), ["in_part", "conv_id"], "left")
    more = lambda c: F.coalesce(F.col(f"`+{c}`"), F.lit(0))
    return both.select(*rows.columns, *[(F.col(c) + more(c)).alias(c) for c in sums], *[F.col(c).bitwiseXOR(more(c)).alias(c) for c in xors])


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations (``conv_id``, ``length``, ...) and the turns they are rebuilt of, by ``depth``: the
    first turns of the group's first conversation, then their own behind as many."""
    found = running(turns.withColumn("one", F.lit(1)), ["turn", "a", "b"], {"place": "one"}, {}, "places")
    found = found.select("conv_id", "place", "a", "b", "bytes")
    convs = found.groupBy("conv_id").agg(F.count("*").alias("n"))
    convs = convs.select("*", (F.col("conv_id") - F.col("conv_id") % GROUP).alias("base"), (F.crc32(F.col("conv_id").cast("string")) % HEADS).alias("h"))
    convs = convs.join(convs.select(F.col("conv_id").alias("base"), F.col("n").alias("offered")), "base", "left")
    taken = F.least("h", F.coalesce("offered", F.lit(0)))
    convs = stored(convs.withColumn("taken", taken).withColumn("length", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "conversations")
    heads = found.where((F.col("place") < HEADS) & (F.col("conv_id") % GROUP == 0)).withColumnRenamed("conv_id", "base")
    first = heads.join(convs.select("base", "conv_id", "taken", "length"), "base").where(F.col("place") <= F.col("taken")).withColumn("depth", F.col("place"))
    later = lookup(found, convs.select("conv_id", "h", "taken", "length", "n"), "conv_id", "n", turns.count()).where(F.col("place") > F.col("h")).withColumn("depth", F.col("place") - F.col("h") + F.col("taken"))
    columns = ["conv_id", "depth", "length", "bytes", F.xxhash64("a", "depth").alias("a"), F.xxhash64("b", "depth").alias("b")]
    return convs, first.select(*columns).unionByName(later.select(*columns))


def id_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sorted ids of each class, comma-joined, one text for a batch."""
    for batch in batches:
        rep, ids = batch["rep"].to_numpy(), batch["conv_id"]
        begin = np.flatnonzero(np.r_[True, rep[1:] != rep[:-1]]) if len(rep) else np.zeros(0, int)
        texts = [",".join(map(str, ids.slice(a, b - a).to_pylist())) for a, b in zip(begin, np.r_[begin[1:], len(rep)])]
        yield pa.RecordBatch.from_arrays([pa.array(rep[begin]), ids.take(pa.array(begin)), pa.array(texts, pa.string())], names=["rep", "first", "ids"])


def id_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each class's texts in order."""
    rows = ((r, t) for batch in batches for r, t in zip(batch["rep"].to_pylist(), batch["ids"].to_pylist()))
    for rep, mine in itertools.groupby(rows, lambda x: x[0]):
        digest = hashlib.sha256()
        for i, (_, text) in enumerate(mine):
            digest.update(b"," * (i > 0) + text.encode())
        yield pa.RecordBatch.from_arrays([pa.array([rep]), pa.array([digest.hexdigest()])], names=["rep", "ends"])


def classes(convs: DataFrame, walked: DataFrame) -> DataFrame:
    """Conversations of equal turns as one row: the smallest ``conv_id``, ``weight``, ``length``, ``total``
    bytes, and ``ends``, the digest of all their ids."""
    last = walked.where(F.col("depth") == F.col("length")).select("conv_id", "length", "x", "y", F.col("upto").alias("total"))
    none = [F.lit(0).cast("long").alias(c) for c in ("x", "y", "total")]
    last = stored(last.unionByName(convs.where("length = 0").select("conv_id", "length", *none)).withColumn("key", F.struct("length", "x", "y")), "last-turns")
    found = stored(last.groupBy("key").agg(F.min("conv_id").alias("rep"), F.count("*").alias("weight"), F.first("length").alias("length"), F.first("total").alias("total")), "classes")
    many = found.where("weight > 1").select("key", "rep", F.col("weight").alias("rows"))
    members = stored(lookup(last, many, "key", "rows", last.count()).select("rep", "conv_id"), "members")
    texts = stored(members.repartitionByRange("rep", "conv_id").sortWithinPartitions("rep", "conv_id").mapInArrow(id_texts, "rep long, first long, ids string"), "id-texts")
    digests = texts.repartition("rep").sortWithinPartitions("rep", "first").mapInArrow(id_digests, "rep long, ends string")
    ends = F.coalesce("ends", F.sha2(F.col("rep").cast("string"), 256))
    return stored(found.join(digests, "rep", "left").select(F.col("rep").alias("conv_id"), "weight", "length", "total", ends.alias("ends")), "representatives")


class Louds:
    """A trie in level order: ``bits`` has for each node a one for each child, then a zero; ``labels`` has the
    nodes' names; ``levels`` tells where each level begins."""

    def __init__(self, labels: np.ndarray, children: np.ndarray, levels: list[int]):
        self.labels, self.levels = labels, levels
        self.bits = np.ones(int(children.sum()) + len(children), bool)
        self.bits[np.cumsum(children + 1) - 1] = False

    def parents(self) -> np.ndarray:
        """The parent of every node but the root: of the j-th one, the number of zeros before it."""
        ones = np.flatnonzero(self.bits)
        return ones - np.arange(len(ones))

    def roll_up(self, *values: np.ndarray) -> None:
        """Adds to each node's values those of the nodes below it, from the deepest level up."""
        above = self.parents()
        for level in range(len(self.levels) - 2, 0, -1):
            a, b = self.levels[level], self.levels[level + 1]
            for v in values:
                np.add.at(v, above[a - 1 : b - 1], v[a:b])


def grow(root: int, sizes: np.ndarray, paths: np.ndarray) -> tuple[Louds, np.ndarray, np.ndarray]:
    """The trie of ``paths`` (of ``sizes``, one after another) below ``root``; for each element of the paths its
    node, and for each path the last node."""
    begin = np.cumsum(sizes) - sizes
    at, node_of = np.zeros(len(sizes), np.int64), np.zeros(len(paths), np.int64)
    labels, counts, levels, level = [np.array([root])], [], [0, 1], 0
    while True:
        live = np.flatnonzero(sizes > level)
        label, parent = paths[begin[live] + level], at[live]
        order = np.lexsort((label, parent))
        fresh = np.r_[True, (label[order][1:] != label[order][:-1]) | (parent[order][1:] != parent[order][:-1])][: len(order)]
        counts.append(np.bincount(parent[order][fresh] - levels[-2], minlength=levels[-1] - levels[-2]))
        if not len(live):
            return Louds(np.concatenate(labels), np.concatenate(counts), levels), node_of, at
        node = np.empty(len(live), np.int64)
        node[order] = np.cumsum(fresh) - 1 + levels[-1]
        at[live] = node_of[begin[live] + level] = node
        labels.append(label[order][fresh])
        levels.append(levels[-1] + int(fresh.sum()))
        level += 1


def shard_nodes(root: int, members: int, reps: pa.Table) -> pa.RecordBatch:
    """Nodes of the trie of whole shards: what is below the heavy ones is complete, these have what the shards give them."""
    sizes = np.asarray(pc.list_value_length(reps["path"]))
    flat = reps["path"].combine_chunks().flatten()
    field = lambda c: flat.field(c).to_numpy(zero_copy_only=False)
    conv, weight, length, rest = (reps[c].to_numpy() for c in ("conv_id", "weight", "length", "rest"))
    trie, node_of, last = grow(root, sizes, field("node"))
    n = len(trie.labels)
    n_convs, size, heavy, mine = np.full(n, members), np.zeros(n, np.int64), np.ones(n, bool), np.zeros(n, bool)
    n_convs[node_of], size[node_of], heavy[node_of] = field("n_convs"), field("bytes"), field("heavy")
    # a heavy node is in many shards; what it has of itself counts where its smallest conversation is
    mine[node_of[field("node") == np.repeat(conv, sizes)]] = True
    mine |= ~heavy
    tail = length > sizes
    leaves, children = np.zeros(n, np.int64), np.zeros(n, np.int64)
    saved = np.where(mine, (n_convs - 1) * size, 0)
    saved[0] = 0
    np.add.at(leaves, last[tail], 1)
    np.add.at(children, last[tail], 1)
    np.add.at(saved, last[tail], ((weight - 1) * rest)[tail])
    parents = trie.parents()
    np.add.at(children, parents[mine[1:]], 1)
    trie.roll_up(leaves, saved)
    ends = np.full(n, None, object)
    ends[last[~tail]] = reps["ends"].to_numpy()[~tail]
    depth = np.repeat(np.arange(len(trie.levels) - 1), np.diff(trie.levels))
    above = pa.array(np.r_[0, trie.labels[parents]], mask=np.arange(n) == 0)
    return pa.RecordBatch.from_arrays([pa.array(trie.labels), pa.array(depth), above, *map(pa.array, (n_convs, children, leaves, saved)), pa.array(ends, pa.string()), pa.array(heavy)], names=[x.split()[0] for x in NODE.split(", ")])


def whole_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by shard, cut between shards."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        held.append(batch)
        there = pa.Table.from_batches(held)
        a, b = (there[c].to_numpy() for c in ("top", "level"))
        cut = np.flatnonzero((a[1:] != a[:-1]) | (b[1:] != b[:-1]))
        if len(cut):
            yield there.slice(0, int(cut[-1]) + 1)
            held = there.slice(int(cut[-1]) + 1).to_batches()
    if held:
        yield pa.Table.from_batches(held)


def shared_nodes(paths: DataFrame, root: int, members: int) -> DataFrame:
    """The root and all nodes that conversations of different turns share, by tries of shards."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shards in whole_shards(batches):
            yield shard_nodes(root, members, shards)

    heavy = F.size(F.filter("path", lambda p: p["heavy"]))
    found = paths.withColumns({"level": F.when(F.size("path") > heavy, heavy + 1).otherwise(0), "top": F.when(F.size("path") > heavy, F.get("path", heavy)["node"]).otherwise(F.col("conv_id"))})
    dealt = found.repartition("top", "level").sortWithinPartitions("top", "level", "conv_id")
    nodes = stored(dealt.mapInArrow(trimmed(build), NODE), "shard-nodes")
    merged = nodes.where("heavy").groupBy("conv_id", "depth").agg(
        F.first("parent_conv_id").alias("parent_conv_id"), F.first("n_convs").alias("n_convs"),
        *[F.sum(c).alias(c) for c in ("n_children", "n_leaves", "saved_tokens")], F.max("ends").alias("ends"),
    )
    # a root alone is a leaf
    merged = merged.withColumn("n_leaves", F.when(F.col("n_children") == 0, 1).otherwise(F.col("n_leaves")))
    return nodes.where("not heavy").drop("heavy").unionByName(merged)


def key_of(*columns: str) -> Column:
    return F.struct(*columns)


@scratched("prefix-trie")
def prefix_trie(conversations: DataFrame, *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", shard_turns: int = SHARD_TURNS) -> DataFrame:
    """Every node of the trie: ``conv_id``, ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` and ``ends_sha256``."""
    turns = named(conversations, conv_id=id_col, turn=turn_col, role=role_col, text=text_col).where("conv_id IS NOT NULL")
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turns = stored(turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.xxhash64(role, text).alias("a"), F.xxhash64(F.lit(1), text, role).alias("b"), F.octet_length(text).cast("long").alias("bytes")), "turns")
    convs, rows = rebuilt(turns)
    walked = stored(running(stored(rows, "rebuilt"), ["depth"], {"upto": "bytes"}, {"x": "a", "y": "b"}, "walked"), "prefixes")
    reps = classes(convs, walked)
    root, members = convs.agg(F.min("conv_id"), F.count("*")).first()
    own = lookup(walked.drop("a", "b", "length"), reps.withColumn("turns", F.col("length")), "conv_id", "turns", walked.count())
    own = stored(own.withColumn("key", key_of("depth", "x", "y")).drop("x", "y"), "own-turns")
    nodes = own.groupBy("key").agg(F.count("*").alias("rows"), F.sum("weight").alias("n_convs"), F.min("conv_id").alias("node"), (F.sum(F.col("length") - F.col("depth")) > shard_turns).alias("heavy")).where("rows > 1")
    own = stored(lookup(own, stored(nodes, "nodes"), "key", "rows", own.count(), how="left").drop("key"), "shared-turns")
    steps = own.where("node IS NOT NULL").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("depth", "node", "bytes", "n_convs", "heavy"))).alias("path"), F.sum("bytes").alias("taken"))
    paths = stored(reps.join(steps, "conv_id", "left").withColumns({"path": F.coalesce("path", F.array()), "rest": F.col("total") - F.coalesce("taken", F.lit(0))}).drop("taken"), "paths")
    above = paths.select("conv_id", F.size("path").alias("shared"), F.coalesce(F.try_element_at("path", F.lit(-1))["node"], F.lit(root)).alias("last"), F.col("length").alias("turns"))
    tails = lookup(own.where("node IS NULL"), above, "conv_id", "turns", own.count()).select(
        "conv_id", "depth", F.when(F.col("depth") == F.col("shared") + 1, F.col("last")).otherwise(F.col("conv_id")).alias("parent_conv_id"), F.col("weight").alias("n_convs"),
        (F.col("depth") < F.col("length")).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
        ((F.col("weight") - 1) * (F.col("total") - F.col("upto") + F.col("bytes"))).alias("saved_tokens"), F.when(F.col("depth") == F.col("length"), F.col("ends")).alias("ends"),
    )
    found = shared_nodes(paths, root, members).unionByName(tails)
    return found.withColumn("ends_sha256", F.coalesce("ends", F.lit(NOBODY))).drop("ends")
