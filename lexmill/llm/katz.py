"""Katz backoff scoring: Good-Turing discounted n-grams of any order, exactly normalised.

    P(w | h) = d(c(h,w)) * c(h,w) / c(h)   if c(h,w) > 0, else   a(h) * P(w | h without its first word)
    a(h)     = (1 - sum of P(w | h) over seen w) / (1 - sum of P(w | shorter h) over the same w)
    P(w)     = d(c(w)) * c(w) / N          if c(w) > 0, else the mass that the discounts left

evaluated order by order, from the lowest up, so that each order has the one below at hand. All words
that follow a context, with one class for words never seen, sum to one. Discounts are Katz's for
counts up to five, for each order by itself; where a corpus has no valid ones, counts lose a half. A
context whose counts leave no mass is scaled by n / (n + 1). A context that was never seen is passed over.

Texts never move. They are tokenised once into blocks of bounded size, kept as files in the folder
that driver and executors share. For each order a block asks for the counts of its distinct n-grams;
questions go to partitions by a hash of the context, where the counts of all blocks are added up:
these are the tables of the model, in partitions. Answers go back in the order of the questions, and
number the n-grams, so that an n-gram of the next order is two numbers, its context's and its word's.
A very common n-gram costs one question per block, and a context with very many followers is spread
over partitions by its followers; so no key gathers rows in one place.

Questions and answers are files in the shared folder too: a task writes one and says where each part
lies, the reader takes its slices. So no message is larger than its slice, a lost executor loses no
messages, and a step's files are deleted as soon as the next one has read them. There is at most one
message for each pair of block and partition, and none without a question.

Words are told apart by 64-bit hashes. Defined results: a null or empty text is its end token
alone; a null id isn't held out; repeated rows are trained on and scored each; extra columns are
ignored; an empty table gives an empty table; without training text every token has probability 1.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.storage import remove, scratched

from .shared import byte_slices, shared_path, stored
from .warc import filesystem

ORDER = 3
#: Counts up to this are discounted.
DISCOUNTED = 5
BLOCK_BYTES = 8_000_000
SLICE_BYTES = 2_000_000
#: Questions that a partition answers, about; followers of a context beyond which it is spread.
WORDS_EACH, GRAMS_EACH, SPREAD = 500_000, 2_000_000, 500_000
#: The end of a text, counted as a word; no word has white space. The context of a text's first word.
END, START = b"\n", 1 << 62
SEED = 5
#: A number is a partition's number and a place in it.
PLACE_BITS = 32


# --- arrays as bytes ------------------------------------------------------------------------


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays, compressed; whole numbers in their narrowest type, first bytes first. Each has its
    type in three letters, its size in four bytes, and its bytes."""
    out = []
    for a in arrays:
        if a.dtype.kind in "iu" and a.dtype != np.uint64:
            a = a.astype(np.min_scalar_type(int(a.max()) if len(a) else 0))
        data = zstandard.compress(a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes(), 1)
        out += [a.dtype.str.encode(), len(data).to_bytes(4, "little"), data]
    return b"".join(out)


def unpack(data: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(data):
        kind, size = np.dtype(data[at : at + 3].decode()), int.from_bytes(data[at + 3 : at + 7], "little")
        planes = np.frombuffer(zstandard.decompress(data[at + 7 : at + 7 + size]), np.uint8).reshape(kind.itemsize, -1)
        out.append(np.ascontiguousarray(planes.T).view(kind).ravel())
        at += 7 + size
    return out


def steps(values: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """Values that rise inside runs, as a run's first value and then differences."""
    out = np.diff(values, prepend=0)
    first = (np.cumsum(runs) - runs)[runs > 0]
    out[first] = values[first]
    return out


def unsteps(differences: np.ndarray, runs: np.ndarray) -> np.ndarray:
    total = np.cumsum(whole(differences))
    first, runs = (np.cumsum(runs) - runs)[runs > 0], runs[runs > 0]
    return total - np.repeat(total[first] - whole(differences)[first], runs)


def one_run(values: np.ndarray) -> np.ndarray:
    return np.array([len(values)])


def whole(a: np.ndarray) -> np.ndarray:
    return a.astype(np.int64)


def grouped(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct values, where each occurs, and each value's place among them.

    Values that aren't negative and places fit into one number as a rule; sorting those is all it takes.
    """
    n = len(values)
    if not n:
        return values, np.zeros(0, np.int64), np.zeros(0, np.int64)
    bits = (n - 1).bit_length()
    if int(values.max()).bit_length() + bits > 63:
        return np.unique(values, return_index=True, return_inverse=True)
    both = np.sort((values << bits) | np.arange(n))
    at, ordered = both & ((1 << bits) - 1), both >> bits
    new = np.append(True, ordered[1:] != ordered[:-1])
    place = np.empty(n, np.int64)
    place[at] = np.cumsum(new) - 1
    return ordered[new], at[new], place


def by_part(part: np.ndarray, parts: int) -> np.ndarray:
    """A stable order of numbers below ``parts``."""
    return np.argsort(part.astype(np.min_scalar_type(parts)), kind="stable")


# --- messages -------------------------------------------------------------------------------

MESSAGE = "part int, block string, path string, first long, size long, stats array<long>"
MESSAGE_ROWS = pa.schema([("part", pa.int32()), ("block", pa.string()), ("path", pa.string()), ("first", pa.int64()), ("size", pa.int64()), ("stats", pa.list_(pa.int64()))])


def write_file(folder: str, data: list[bytes]) -> str:
    where, place = filesystem(f"{folder}/{uuid.uuid4().hex}")
    where.create_dir(place.rpartition("/")[0], recursive=True)
    with where.open_output_stream(place) as sink:
        for x in data:
            sink.write(x)
    return f"{folder}/{place.rpartition('/')[2]}"


def send(folder: str, messages: list[tuple[int, str, bytes]], stats: tuple[int, str | None, list[int]] | None = None) -> pa.Table:
    """Writes the messages (part, block, body) to one file; rows that say where they are, and one of
    no block with the part's table and counts of counts."""
    path = write_file(folder, [body for *_, body in messages]) if messages else ""
    rows, at = [], 0
    for part, block, body in messages:
        rows.append((part, block, path, at, len(body), None))
        at += len(body)
    rows += [(stats[0], None, stats[1], None, None, stats[2])] if stats else []
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * len(MESSAGE_ROWS), MESSAGE_ROWS, strict=True)], schema=MESSAGE_ROWS)


def receive(rows: pa.Table) -> Iterator[list[np.ndarray]]:
    """The bodies of messages, in the rows' order."""
    for path, first, size in zip(*(rows.column(k).to_pylist() for k in ("path", "first", "size")), strict=True):
        where, place = filesystem(path)
        with where.open_input_file(place) as source:
            source.seek(first)
            yield unpack(source.read(size))


# --- blocks ---------------------------------------------------------------------------------


class Places(dict):
    def __missing__(self, word: bytes) -> int:
        place = self[word] = len(self)
        return place


@dataclass
class Piece:
    """A text or a part of one: the words before it, whether it begins and ends the text, and a name
    that the parts of one text share."""

    body: bytes
    lead: list[bytes]
    begins: bool = True
    ends: bool = True
    whole: str | None = None


def pieces(text: bytes, context: int, limit: int = BLOCK_BYTES) -> Iterator[Piece]:
    """A text in pieces of about ``limit`` bytes, each with the ``context`` words before it."""
    if len(text) <= limit:
        yield Piece(text, [])
        return
    whole, lead, begins, held = uuid.uuid4().hex, [], True, None
    for body in byte_slices(text, limit):
        words = body.lower().split()
        if not words:
            continue
        if held:
            yield held
        held = Piece(body, lead, begins, False, whole)
        lead, begins = (lead + words)[len(lead) + len(words) - context :] if len(lead) + len(words) > context else lead + words, False
    held = held or Piece(b"", [], whole=whole)
    held.ends = True
    yield held


def write_block(folder: str, keys: pa.Array, held: np.ndarray, texts: list[Piece]) -> tuple[str, int, int]:
    """Tokenises texts into a file: ids, held-out flags, tokens per text and how many of them are
    context, hashes of distinct words by falling frequency, and tokens as places among them. Returns
    path, tokens and distinct words."""
    places = Places()
    end = places[END]
    tokens, counts = [], []
    for text in texts:
        lead = np.fromiter(map(places.__getitem__, text.lead), np.uint32, len(text.lead))
        tokens.append(lead)
        n = len(lead)
        for part in byte_slices(text.body.lower(), SLICE_BYTES):
            words = part.split()
            tokens.append(np.fromiter(map(places.__getitem__, words), np.uint32, len(words)))
            n += len(words)
        if text.ends:
            tokens.append(np.array([end], np.uint32))
        counts.append(n + text.ends)
    flat = np.concatenate(tokens)
    order = np.argsort(-np.bincount(flat, minlength=len(places)), kind="stable")
    rank = np.empty(len(order), np.uint32)
    rank[order] = np.arange(len(order), dtype=np.uint32)
    hashes = np.fromiter((xxhash.xxh64_intdigest(w, SEED) for w in places), np.uint64, len(places))
    leads = np.array([len(t.lead) for t in texts])
    rows, sink = pa.table({"keys": keys, "whole": pa.array([t.whole for t in texts], pa.string())}), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as writer:
        writer.write_table(rows)
    ids = sink.getvalue().to_pybytes()
    path = write_file(folder, [len(ids).to_bytes(8, "little"), ids, pack(held.astype(np.uint8), np.array(counts), leads, hashes[order], rank[flat])])
    return path, len(flat) - int(leads.sum()), len(places)


class Block:
    """A block's file, read back."""

    def __init__(self, path: str):
        where, place = filesystem(path)
        with where.open_input_file(place) as source:
            data = source.read()
        cut = 8 + int.from_bytes(data[:8], "little")
        rows = pa.ipc.open_stream(data[8:cut]).read_all().combine_chunks()
        self.keys, self.whole = rows.column("keys"), rows.column("whole")
        held, counts, leads, hashes, tokens = unpack(data[cut:])
        order = np.argsort(hashes)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        # from here on words are in the order of their hashes, which is that of their numbers
        self.hashes, self.tokens = hashes[order], rank[tokens]
        self.held, self.leads, counts = held.astype(bool), whole(leads), whole(counts)
        self.first, self.counts = np.cumsum(counts) - counts, counts - self.leads
        # tokens that are no context of a later piece
        self.own = np.arange(len(tokens)) - np.repeat(self.first, counts) >= np.repeat(self.leads, counts)
        self.learnt = self.own & np.repeat(~self.held, counts)

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Sums of values of tokens by text."""
        return np.add.reduceat(np.where(self.own, values, 0), self.first)


def blocks(docs: DataFrame, folder: str, held: Column, context: int, *, id_col: str, text_col: str) -> DataFrame:
    """Writes blocks and returns their stored manifest ``block, tokens, words, learnt_docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, texts, size = [], [], 0

        def give() -> pa.RecordBatch:
            keys = pa.concat_arrays([k for k, _ in rows])
            flags = np.array([h for _, h in rows])
            made = write_block(folder, keys, flags, texts)
            learnt = int((~flags & np.array([t.begins for t in texts])).sum())
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in (*made, learnt)], ["block", "tokens", "words", "learnt_docs"])

        for batch in batches:
            bodies = batch.column(1).cast(pa.binary())
            for i, (h, text) in enumerate(zip(batch.column(2).to_pylist(), bodies, strict=True)):
                for piece in pieces(text.as_py() or b"", context, BLOCK_BYTES):
                    rows.append((batch.column(0).slice(i, 1), h))
                    texts.append(piece)
                    size += len(piece.body) + 16
                    if size > BLOCK_BYTES:
                        yield give()
                        rows, texts, size = [], [], 0
        if rows:
            yield give()

    found = docs.select(F.col(id_col), F.col(text_col), held.alias("held"))
    return stored(found.mapInArrow(run, "block string, tokens long, words long, learnt_docs long"), "blocks")


# --- discounts ------------------------------------------------------------------------------


def counts_of_counts(totals: np.ndarray) -> list[int]:
    """Sum, number that aren't zero, and how many are 1, 2, ... up to one beyond the discounted."""
    return [int(totals.sum()), int((totals > 0).sum())] + [int((totals == r).sum()) for r in range(1, DISCOUNTED + 2)]


class Discounts:
    """Factors for counts up to ``DISCOUNTED``, from counts of counts; all are above 0 and below 1."""

    def __init__(self, stats: list[int]):
        n = [0, *stats[2:]]
        k = DISCOUNTED
        factors = []
        if min(n[1 : k + 2]) > 0:
            beyond = (k + 1) * n[k + 1] / n[1]
            if beyond < 1:
                factors = [((r + 1) * n[r + 1] / (r * n[r]) - beyond) / (1 - beyond) for r in range(1, k + 1)]
        if not factors or not all(0 < f < 1 for f in factors):
            factors = [(r - 0.5) / r for r in range(1, k + 1)]
        self.factors = np.array([0.0, *factors, 1.0])
        self.total, self.types = stats[0], stats[1]
        # of single words: what the discounts leave; without mass for unseen words, one more token makes some
        left = sum(c * (r - float(self(np.array([r]))[0])) for r, c in enumerate(stats[2 : 2 + DISCOUNTED], 1))
        self.norm, self.left = (self.total, left) if left > 0 else (self.total + 1, 1.0)

    def __call__(self, counts: np.ndarray) -> np.ndarray:
        """Discounted counts."""
        return self.factors[np.minimum(counts, DISCOUNTED + 1)] * counts


def stats_of(answers: DataFrame) -> list[int]:
    """Sums of the partitions' counts of counts."""
    row = answers.where("block IS NULL").agg(*[F.sum(F.col("stats")[i]).alias(str(i)) for i in range(DISCOUNTED + 3)]).first()
    return [int(x or 0) for x in row]


# --- n-grams of a block ---------------------------------------------------------------------


@dataclass
class Grams:
    """A block's n-grams of one order: for each token the place of the n-gram that it ends, for each
    n-gram its count and number, and for each token the scale of its context's counts."""

    place: np.ndarray
    count: np.ndarray
    number: np.ndarray
    norm: np.ndarray


def place_of(context: np.ndarray, lane: np.ndarray, parts: int) -> np.ndarray:
    x = (context.astype(np.uint64) ^ (lane.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xD6E8FEB86659FD93)
    return ((x ^ (x >> np.uint64(32))) % np.uint64(parts)).astype(np.int64)


def word_ranges(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Bounds of the parts among sorted hashes: each has an equal share of the hash space."""
    width = (1 << 64) // parts + 1
    return np.concatenate(([0], np.searchsorted(hashes, np.array([width * i for i in range(1, parts)], np.uint64)), [len(hashes)])).astype(np.int64)


class Questions:
    """What a block asks about its n-grams of one order above the first.

    Distinct n-grams are pairs of a context, a place among the n-grams of the order below or
    behind them for the start of a text, and a word, in the order of their numbers. ``asked`` are those
    whose context and whose shorter n-gram have counts, part by part. At each part there are contexts,
    ``run`` of which says how many asked n-grams follow it there. A context ``wants`` its sums if a word
    follows it that isn't asked about, or if it is spread, so that each of its places is asked.
    """

    def __init__(self, block: Block, words: Grams, lower: Grams, learnt_docs: int, parts: int, spread: int):
        n_words, n_lower = len(words.count), len(lower.count)
        self.context_count, number = np.append(lower.count, learnt_docs), np.append(lower.number, START)
        # contexts in the order of their numbers, so that these rise
        by_number = np.argsort(number)
        rank = np.empty(n_lower + 1, np.int64)
        rank[by_number] = np.arange(n_lower + 1)
        self.token_context = np.empty(len(block.tokens), np.int64)
        self.token_context[1:] = lower.place[:-1]
        self.token_context[block.first] = n_lower
        distinct, self.at, self.place = grouped(rank[self.token_context] * n_words + block.tokens)
        self.size = len(distinct)
        self.context, word = self.token_context[self.at], block.tokens[self.at]
        self.lower_count = lower.count[lower.place[self.at]]
        known = self.context_count[self.context] > 0
        is_asked = known & (self.lower_count > 0)
        lanes = np.maximum(1, -(-self.context_count // spread))
        self.norm = np.zeros(n_lower + 1, np.int64)
        self.norm[self.context] = lower.norm[self.at]
        wants = lanes > 1
        wants[self.context[known & ~is_asked]] = True
        # at each part: every lane of a known context, once
        own = by_number[self.context_count[by_number] > 0]
        own = own[np.bincount(self.context, minlength=n_lower + 1)[own] > 0]
        every, wide = place_of(number[own], np.zeros(len(own), np.int64), parts) * (n_lower + 1) + rank[own], own[lanes[own] > 1]
        if len(wide):
            lane = np.concatenate([np.arange(1, n) for n in lanes[wide].tolist()])
            again = np.repeat(wide, lanes[wide] - 1)
            every = np.concatenate([every, place_of(number[again], lane, parts) * (n_lower + 1) + rank[again]])
        every = np.sort(every)
        every = every[np.append(True, every[1:] != every[:-1])[: len(every)]]
        at_part, self.at_context = every // (n_lower + 1), by_number[every % (n_lower + 1)]
        self.wants, self.at_number = wants[self.at_context], number[self.at_context]
        asked = np.flatnonzero(is_asked)
        c, w = self.context[asked], words.number[word[asked]]
        where = place_of(number, np.zeros(n_lower + 1, np.int64), parts)[c]
        spread_out = lanes[c] > 1
        where[spread_out] = place_of(number[c[spread_out]], w[spread_out] % lanes[c[spread_out]], parts)
        order = by_part(where, parts)
        self.asked, self.asked_word = asked[order], w[order]
        # runs: of a context that has one place only by that place, of others by part and rank
        slot = np.zeros(n_lower + 1, np.int64)
        slot[self.at_context] = np.arange(len(self.at_context))
        slots = slot[c]
        if len(wide):
            slots[spread_out] = np.searchsorted(every, where[spread_out] * (n_lower + 1) + rank[c[spread_out]])
        self.run = np.bincount(slots, minlength=len(at_part))
        self.context_bounds = np.searchsorted(at_part, np.arange(parts + 1))
        self.gram_bounds = np.concatenate(([0], np.cumsum(self.run)))[self.context_bounds]

    def parts(self) -> Iterator[tuple[int, slice, slice]]:
        """Each part with its contexts and its asked n-grams."""
        for p in np.flatnonzero(np.diff(self.context_bounds)).tolist():
            yield p, slice(*self.context_bounds[p : p + 2]), slice(*self.gram_bounds[p : p + 2])

    def bodies(self, own: np.ndarray) -> Iterator[tuple[int, bytes]]:
        """A message for each part: contexts with what they want, the scale of their shorter context
        and their runs; words, and counts of n-grams in the block and of the shorter ones."""
        for p, contexts, grams in self.parts():
            asked, run = self.asked[grams], self.run[contexts]
            number = self.at_number[contexts]
            yield p, pack(
                steps(number, one_run(number)), self.wants[contexts].astype(np.uint8), self.norm[self.at_context[contexts]], run,
                steps(self.asked_word[grams], run), own[asked], self.lower_count[asked],
            )


@dataclass
class Model:
    """What a step knows of the orders that are done: a folder, how many texts were learnt from, the
    number of parts of each order, and each order's discounts."""

    learnt_docs: int
    spread: int
    parts: list[int]
    discounts: list[Discounts]


class Climb:
    """A block's n-grams order by order, from the answers about them."""

    def __init__(self, block: Block, model: Model, messages: pa.Table):
        self.block, self.model = block, model
        kinds, parts = messages.column("kind").to_pylist(), messages.column("part").to_pylist()
        self.at: dict[int, dict[int, int]] = defaultdict(dict)
        for i, (k, p) in enumerate(zip(kinds, parts, strict=True)):
            self.at[k][p] = i
        self.messages = messages
        self.words = self.single()

    def answers(self, order: int) -> Iterator[tuple[int, list[np.ndarray]]]:
        """Part and body of the answers about an order, by part."""
        rows = sorted(self.at[order].items())
        yield from zip((p for p, _ in rows), receive(self.messages.take(pa.array([i for _, i in rows], pa.int64()))), strict=True)

    def single(self) -> Grams:
        block, count, number = self.block, [], []
        for p, (totals, at) in self.answers(1):
            count.append(whole(totals))
            number.append((p << PLACE_BITS) + np.cumsum(whole(at)))
        return Grams(block.tokens, np.concatenate(count), np.concatenate(number), np.full(len(block.tokens), self.model.discounts[0].norm, np.int64))

    def questions(self, order: int, lower: Grams) -> Questions:
        return Questions(self.block, self.words, lower, self.model.learnt_docs, self.model.parts[order - 1], self.model.spread)

    def up(self, order: int, lower: Grams) -> tuple[Grams, Questions, np.ndarray]:
        """The n-grams of an order, with what was asked, and the weight of each context's backoff,
        which is right where it wants one."""
        q, discount = self.questions(order, lower), self.model.discounts[order - 1]
        count, number = np.zeros((2, q.size), np.int64)
        kept, chances, partial = np.zeros(len(q.context_count)), np.zeros(len(q.context_count)), np.zeros(len(q.context_count), bool)
        answers = dict(self.answers(order))
        for p, contexts, grams in q.parts():
            totals, at, full, told, *sums, chance = answers[p]
            count[q.asked[grams]] = totals
            if len(at):
                number[q.asked[grams]] = (p << PLACE_BITS) + np.cumsum(whole(at))
            # a context stands once at a part, so plain indexing adds up
            where = q.at_context[contexts]
            partial[where] |= full == 0
            where = where[told > 0]
            kept[where] += discount(np.arange(1, DISCOUNTED + 1)) @ np.stack([whole(x) for x in sums[:DISCOUNTED]]) + whole(sums[DISCOUNTED])
            chances[where] += chance
        norm = q.context_count + ~partial
        with np.errstate(divide="ignore", invalid="ignore"):
            weight = np.where(q.context_count > 0, (1 - kept / norm) / (1 - chances), 1.0)
        return Grams(q.place, count, number, norm[q.token_context]), q, weight

    def top(self, order: int) -> Grams:
        """The n-grams of an order whose answers are there."""
        found = self.words
        for k in range(2, order + 1):
            found, _, _ = self.up(k, found)
        return found

    def chances(self) -> np.ndarray:
        """The probability of each token, by the highest order."""
        discount, found = self.model.discounts[0], self.words
        p = (np.where(found.count > 0, discount(found.count), discount.left) / discount.norm)[found.place]
        for k in range(2, len(self.model.discounts) + 1):
            found, q, weight = self.up(k, found)
            norm = found.norm[q.at]
            with np.errstate(divide="ignore", invalid="ignore"):
                p = np.where(found.count > 0, self.model.discounts[k - 1](found.count) / norm, weight[q.context] * p[q.at])[q.place]
        return p


# --- steps ----------------------------------------------------------------------------------


def ask_words(manifest: DataFrame, folder: str, parts: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                block = Block(name)
                own, bounds = np.bincount(block.tokens[block.learnt], minlength=len(block.hashes)), word_ranges(block.hashes, parts)
                bodies = [(p, name, pack(block.hashes[a:b], own[a:b])) for p, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)) if b > a]
                yield from send(folder, bodies).to_batches()

    return manifest.select("block").mapInArrow(run, MESSAGE)


def answer_words(folder: str, keep: str | None) -> Callable[[pa.Table], pa.Table]:
    """Counts of words, which become numbers in the order of their hashes."""

    def run(rows: pa.Table) -> pa.Table:
        bodies, part = list(receive(rows)), rows.column("part")[0].as_py()
        distinct, place = np.unique(np.concatenate([b[0] for b in bodies]), return_inverse=True)
        totals = np.bincount(place, np.concatenate([whole(b[1]) for b in bodies]), len(distinct)).astype(np.int64)
        path = write_table(f"{keep}/1", {"word": (part << PLACE_BITS) + np.arange(len(distinct)), "hash": distinct.view(np.int64), "count": totals}) if keep else None
        cuts = np.cumsum([len(b[0]) for b in bodies])[:-1]
        names = rows.column("block").to_pylist()
        return send(folder, [(part, name, pack(totals[at], steps(at, one_run(at)))) for name, at in zip(names, np.split(place, cuts), strict=True)], (part, path, counts_of_counts(totals)))

    return run


def ask_grams(told: DataFrame, folder: str, model: Model, n_blocks: int) -> DataFrame:
    """Questions about the order above those that ``told`` has the answers to."""
    order = len(model.discounts) + 1

    def run(rows: pa.Table) -> pa.Table:
        name = rows.column("block")[0].as_py()
        block = Block(name)
        climb = Climb(block, model, rows)
        q = climb.questions(order, climb.top(order - 1))
        own = np.bincount(q.place, block.learnt, q.size).astype(np.int64)
        return send(folder, [(p, name, body) for p, body in q.bodies(own)])

    return told.repartition(n_blocks, "block").groupBy("block").applyInArrow(run, MESSAGE)


def answer_grams(folder: str, lower: Discounts, last: bool, keep: str | None, order: int) -> Callable[[pa.Table], pa.Table]:
    """Counts of n-grams and, for contexts that want them, how many of their n-grams have each
    discounted count, the sum of the other counts, and the sum of the words' lower probabilities."""

    def run(rows: pa.Table) -> pa.Table:
        bodies, part = list(receive(rows)), rows.column("part")[0].as_py()
        contexts, _, context_at = grouped(np.concatenate([np.cumsum(whole(b[0])) for b in bodies]))
        gram_context = np.repeat(context_at, np.concatenate([whole(b[3]) for b in bodies]))
        norms = np.ones(len(contexts), np.int64)
        norms[context_at] = np.concatenate([whole(b[2]) for b in bodies])
        followers, _, follower_at = grouped(np.concatenate([unsteps(b[4], whole(b[3])) for b in bodies]))
        distinct, first, place = grouped(gram_context * max(1, len(followers)) + follower_at)
        totals = np.bincount(place, np.concatenate([whole(b[5]) for b in bodies]), len(distinct)).astype(np.int64)
        seen = totals > 0
        of, c = gram_context[first][seen], totals[seen]
        chance = lower(np.concatenate([whole(b[6]) for b in bodies])[first][seen]) / norms[of]
        sums = [np.bincount(of, c == r, len(contexts)).astype(np.int64) for r in range(1, DISCOUNTED + 1)]
        full = np.stack(sums).sum(axis=0) == 0
        sums.append(np.bincount(of, np.where(c > DISCOUNTED, c, 0), len(contexts)).astype(np.int64))
        chances = np.bincount(of, chance, len(contexts))
        columns = {"context": contexts[of], "word": followers[follower_at[first][seen]], "number": (part << PLACE_BITS) + np.flatnonzero(seen), "count": c, "lower": chance}
        path = write_table(f"{keep}/{order}", columns) if keep else None
        messages = []
        cuts, context_cuts = np.cumsum([len(b[4]) for b in bodies])[:-1], np.cumsum([len(b[0]) for b in bodies])[:-1]
        for name, body, at, c_at in zip(rows.column("block").to_pylist(), bodies, np.split(place, cuts), np.split(context_at, context_cuts), strict=True):
            told = body[1] > 0
            told[np.repeat(np.arange(len(c_at)), whole(body[3]))[totals[at] == 0]] = True
            numbers = np.zeros(0, np.int64) if last else steps(at, one_run(at))
            messages.append((part, name, pack(totals[at], numbers, full[c_at].astype(np.uint8), told.astype(np.uint8), *[s[c_at][told] for s in sums], chances[c_at][told])))
        return send(folder, messages, (part, path, counts_of_counts(totals)))

    return run


def write_table(folder: str, columns: dict[str, np.ndarray]) -> str:
    """A part's table as a file of its own name, which the part's row tells."""
    sink = pa.BufferOutputStream()
    pq.write_table(pa.table(columns), sink, compression="zstd")
    return write_file(folder, [sink.getvalue().to_pybytes()])


SUMMED = ("n_tokens", "n_known", "base_score", "score")
SCORES = "held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score_blocks(told: DataFrame, model: Model, n_blocks: int, kind: str) -> DataFrame:
    def run(rows: pa.Table) -> pa.Table:
        block = Block(rows.column("block")[0].as_py())
        climb, words = Climb(block, model, rows), model.discounts[0]
        count = climb.words.count
        base = np.log10((count + 1) / (words.total + words.types + 1))
        columns = [
            block.keys, pa.array(block.held), pa.array(block.counts), pa.array(block.sums((count > 0).astype(np.int64)[block.tokens])), pa.array(np.full(len(block.counts), words.total, np.int64)),
            pa.array(block.sums(base[block.tokens])), pa.array(block.sums(np.log10(climb.chances()))), block.whole,
        ]
        return pa.table(columns, names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "whole"])

    return told.repartition(n_blocks, "block").groupBy("block").applyInArrow(run, f"doc_id {kind}, {SCORES}, whole string")


@scratched("scores")
def score(docs: DataFrame, held: Column, *, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, words_each: int = WORDS_EACH, grams_each: int = GRAMS_EACH, spread: int = SPREAD, keep: str | None = None) -> DataFrame:
    """Learns from the rows where ``held`` isn't true and scores all rows, by n-grams of ``order`` words.

    With ``keep``, a folder, the model's tables stay there, for ``tables``.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    manifest = blocks(docs, shared_path(spark, "tokens"), F.coalesce(held, F.lit(False)), order - 1, id_col=id_col, text_col=text_col)
    n_blocks, tokens, n_words, learnt_docs = manifest.agg(F.count(F.lit(1)), F.sum("tokens"), F.sum("words"), F.sum("learnt_docs")).first()
    if not n_blocks:
        return spark.createDataFrame([], f"doc_id {kind}, {SCORES}")
    model, told = Model(learnt_docs, spread, [], []), None
    for k in range(1, order + 1):
        model.parts.append(-(-n_words // words_each) if k == 1 else -(-tokens // grams_each))
        asking, telling = shared_path(spark, f"questions-{k}"), shared_path(spark, f"answers-{k}")
        asked = ask_words(manifest.repartition(n_blocks), asking, model.parts[0]) if k == 1 else ask_grams(told, asking, model, n_blocks)
        answer = answer_words(telling, keep) if k == 1 else answer_grams(telling, model.discounts[-1], k == order, keep, k)
        asked = stored(asked, "asked")
        answers = stored(asked.repartitionById(model.parts[-1], F.col("part")).groupBy("part").applyInArrow(answer, MESSAGE), "answered")
        remove(spark, asking)
        model.discounts.append(Discounts(stats_of(answers)))
        if keep:
            answers.where("block IS NULL").select("part", "path").write.parquet(f"{keep}/parts/order={k}")
        answers = answers.where("block IS NOT NULL").withColumn("kind", F.lit(k))
        told = answers if told is None else told.unionByName(answers)
    if keep:
        rows = [(k, d.norm, d.left, d.factors.tolist()) for k, d in enumerate(model.discounts, 1)]
        spark.createDataFrame(rows, "order int, norm long, left double, factors array<double>").write.parquet(f"{keep}/discounts")
    scored = stored(score_blocks(told, model, n_blocks, kind), "scored")
    parts = scored.where("whole IS NOT NULL").groupBy("whole")
    joined = parts.agg(*[(F.sum if c in SUMMED else F.first)(c).alias(c) for c in scored.columns if c != "whole"])
    return scored.where("whole IS NULL").drop("whole").unionByName(joined.drop("whole"))


def table(spark: SparkSession, keep: str, order: int) -> DataFrame:
    """The table of an order that ``score`` kept: ``word, hash, count, p`` of words, else ``context,
    word, number, count, p, alpha``. A context is the number of an n-gram of the order below, or START;
    ``alpha`` is the weight of what a context backs off to."""
    columns = {"word": "long", "hash": "long", "count": "long"} if order == 1 else {"context": "long", "word": "long", "number": "long", "count": "long", "lower": "double"}
    schema = pa.schema([(k, pa.int64() if v == "long" else pa.float64()) for k, v in columns.items()])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                where, place = filesystem(path)
                with where.open_input_file(place) as source:
                    yield from pq.ParquetFile(source).read().cast(schema).to_batches(100_000)

    files = spark.read.parquet(f"{keep}/parts").where(F.col("order") == order)
    rows = files.select("path").repartition(max(1, files.count())).mapInArrow(read, ", ".join(f"{k} {v}" for k, v in columns.items()))
    facts = spark.read.parquet(f"{keep}/discounts").where(F.col("order") == order).first()
    factors = F.array(*map(F.lit, facts.factors))
    kept = factors[F.least(F.col("count"), F.lit(DISCOUNTED + 1)).cast("int")] * F.col("count")
    if order == 1:
        return rows.select("*", (kept / facts.norm).alias("p"))
    sums = rows.groupBy("context").agg(F.sum("count").alias("n"), F.sum(kept).alias("kept"), F.sum("lower").alias("below"), F.min("count").alias("least"))
    norm = F.col("n") + (F.col("least") > DISCOUNTED).cast("long")
    scales = sums.select("context", norm.alias("norm"), ((1 - F.col("kept") / norm) / (1 - F.col("below"))).alias("alpha"))
    return rows.join(scales, "context").select("context", "word", "number", "count", (kept / F.col("norm")).alias("p"), "alpha")
