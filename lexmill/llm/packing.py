"""Best-fit packing of tokenised documents, improved by swap-based local search.

Documents become token pieces in one Arrow pass over whole texts; from then on only piece
lengths travel. Pieces are dealt evenly over shards of bounded size and each shard is packed by
itself, so no key can make a shard large and a corpus of any size loses less than one sequence
a shard.

The local search looks at every bin, every piece and every pair of pieces; pieces of one length are
alike, so a bin of ``capacity`` tokens offers at most ``capacity`` different exchanges.

Defined results: a null or empty text is one piece that holds the end id alone; repeated rows are
packed once each; an empty table packs to an empty table; extra columns are ignored.
"""

from __future__ import annotations

import functools
import json
import math
import os
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import byte_slices, stored, trimmed

CAPACITY = 2048
END_ID = 0
SHARD_PIECES = 20_000
TOKENIZER = "word_bpe_49k.json"
#: Words that a worker keeps with their ids, and their bytes; beyond either it starts anew.
CACHE_WORDS, CACHE_BYTES = 1_500_000, 40_000_000
SLICE_BYTES = 1_000_000
#: A full stop or comma that ends a word of ASCII letters is a token of its own in this vocabulary.
STOP = re.compile(rb"(?<=[a-z])([.,])(?![^\x20\x09-\x0D])")
#: Words of Latin letters, U+00C0 to U+00FF included, which the vocabulary doesn't cut further.
LETTERS = re.compile(rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")


class Places(dict):
    """Numbers words as they are asked for; ``new`` has those since it was last emptied."""

    def __init__(self):
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        place = self[word] = len(self)
        self.new.append(word)
        return place


def tokenizer_path(name: str) -> str:
    """A file's path as given, or the place of a public vocabulary of that name."""
    if os.path.exists(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


class WordTokens:
    """Token ids of whole texts through a cache of white-space separated words.

    The vocabulary never joins text across white space, so ids of a text are those of its words
    in order; it lower-cases, so ASCII letters are folded first, but in words that spell an added
    token in some case: those are matched before folding. A file that doesn't behave so is refused.
    Ids lie in one growing pool; a word maps to its place there.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        place = tokenizer_path(path)
        self.tokenizer = Tokenizer.from_file(place)
        with open(place, encoding="utf-8") as f:
            facts = json.load(f)
        self.check(facts)
        self.marks = [t["content"].lower().encode() for t in facts.get("added_tokens") or []]
        self.ends_word = np.zeros(max(self.tokenizer.get_vocab().values()) + 1, bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.ends_word[i] = token.endswith("</w>")
        self.reset()

    def check(self, facts: dict) -> None:
        """Raises if words can't be encoded one by one, folded, with final stops apart."""
        ids = lambda x: self.tokenizer.encode(x, add_special_tokens=False).ids
        added = facts.get("added_tokens") or []
        whole = all(not any(t[k] for k in ("normalized", "lstrip", "rstrip", "single_word")) and len(t["content"].split()) == 1 for t in added)
        folds = ids("Ab CD") == ids("ab cd") == ids("ab") + ids("cd")
        stops = all(ids(f"ab{x}") == ids("ab") + ids(x) for x in ".,")
        if not (whole and folds and stops and facts["model"].get("end_of_word_suffix") == "</w>"):
            raise ValueError("the tokenizer doesn't encode folded words one by one")

    def split(self, text: bytes) -> list[bytes]:
        """Words to encode, in order."""
        low = text.lower()
        if not any(m in low for m in self.marks):
            return STOP.sub(rb" \1", low).split()
        out = []
        for word in text.split():
            folded = word.lower()
            out += [word] if any(m in folded for m in self.marks) else STOP.sub(rb" \1", folded).split()
        return out

    def reset(self) -> None:
        self.place = Places()
        self.starts, self.lengths = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.pool, self.used, self.bytes = np.zeros(4096, np.uint32), 0, 0

    def ids_of(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of ``words`` one after another, and how many each has."""
        found = [x.ids for x in self.tokenizer.encode_batch_fast([w.decode("utf-8") for w in words], add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter((i for x in found for i in x), np.uint32, int(sizes.sum())), sizes

    def ids_of_letters(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """As ``ids_of``, for words of letters: one text, cut after each id that ends a word."""
        lines = [b" ".join(words[i : i + 200]).decode("utf-8") for i in range(0, len(words), 200)]
        flat = np.fromiter((i for x in self.tokenizer.encode_batch_fast(lines, add_special_tokens=False) for i in x.ids), np.uint32)
        ends = np.flatnonzero(self.ends_word[flat]) + 1
        return (flat, np.diff(ends, prepend=0)) if len(ends) == len(words) else self.ids_of(words)

    def learn(self) -> None:
        """Encodes the words that were numbered last."""
        words, self.place.new = self.place.new, []
        first = len(self.place) - len(words)
        is_plain = np.fromiter((LETTERS.fullmatch(w) is not None for w in words), bool, len(words))
        (flat_a, sizes_a), (flat_b, sizes_b) = self.ids_of_letters([w for w, x in zip(words, is_plain, strict=True) if x]), self.ids_of([w for w, x in zip(words, is_plain, strict=True) if not x])
        flat, sizes = np.concatenate((flat_a, flat_b)), np.concatenate((sizes_a, sizes_b))
        while len(self.starts) < len(self.place):
            self.starts, self.lengths = np.resize(self.starts, 2 * len(self.starts)), np.resize(self.lengths, 2 * len(self.lengths))
        while len(self.pool) < self.used + len(flat):
            self.pool = np.resize(self.pool, 2 * len(self.pool))
        self.pool[self.used : self.used + len(flat)] = flat
        at = first + np.concatenate((np.flatnonzero(is_plain), np.flatnonzero(~is_plain)))
        self.lengths[at] = sizes
        self.starts[at] = self.used + np.cumsum(sizes) - sizes
        self.used += len(flat)

    def encode(self, slices: list[bytes]) -> list[np.ndarray]:
        """Ids of each slice of text."""
        split = [self.split(x) for x in slices]
        counts = np.fromiter(map(len, split), np.int64, len(split))
        words = [w for x in split for w in x]
        if len(self.place) > CACHE_WORDS or self.bytes > CACHE_BYTES:
            self.reset()
        at = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
        self.bytes += sum(map(len, self.place.new))
        self.learn()
        sizes = self.lengths[at]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        flat = self.pool[np.repeat(self.starts[at] - (ends - sizes), sizes) + np.arange(total)]
        bounds = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(counts)))]
        return [flat[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


@functools.lru_cache(maxsize=1)
def worker_tokens(path: str) -> WordTokens:
    """A worker's encoder, kept with its words from task to task."""
    return WordTokens(path)


def encoded(texts: Iterable[bytes], words: WordTokens) -> Iterator[np.ndarray]:
    """Ids of each text, texts gathered up to a bounded number of bytes and long ones sliced."""
    held: list[bytes] = []
    size = 0
    for text in texts:
        if len(text) > SLICE_BYTES:
            yield from words.encode(held)
            held, size = [], 0
            yield np.concatenate([words.encode([x])[0] for x in byte_slices(text, SLICE_BYTES)])
            continue
        held.append(text)
        size += len(text)
        if size > SLICE_BYTES:
            yield from words.encode(held)
            held, size = [], 0
    yield from words.encode(held)


def token_pieces(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER, capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """Pieces of at most ``capacity`` ids; with ``keep_ids`` the ids come along as an array."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = worker_tokens(tokenizer)
        for batch in batches:
            texts = (x.as_py() or b"" for x in batch.column(1).cast(pa.binary()))
            out: dict[str, list] = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")}
            for key, ids in zip(batch.column(0).to_pylist(), encoded(texts, words), strict=True):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity]
                    for name, value in (("doc_id", key), ("piece", piece), ("start", start), ("length", len(part)), ("ids_crc32", zlib.crc32(part.tobytes())), ("ids", part.astype(np.int32))):
                        out[name].append(value)
            columns = [pa.array(out["doc_id"], batch.column(0).type), pa.array(out["piece"], pa.int32())] + [pa.array(out[k], pa.int64()) for k in ("start", "length", "ids_crc32")]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if keep_ids:
                columns, names = [*columns, pa.array(out["ids"], pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(trimmed(cut), schema)


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Best-fit decreasing: each piece goes to the fullest bin that still takes it.

    Bit ``s`` of ``open_bits`` says whether some bin has ``s`` free places.
    """
    bins: list[list[int]] = []
    by_space: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_bits = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        rest = open_bits >> size
        if rest:
            space = size + (rest & -rest).bit_length() - 1
            target = by_space[space].pop()
            if not by_space[space]:
                open_bits &= ~(1 << space)
            bins[target].append(i)
        else:
            space, target = capacity, len(bins)
            bins.append([i])
        if left := space - size:
            by_space[left].append(target)
            open_bits |= 1 << left
    return bins


def exchange_sizes(lengths: list[int]) -> tuple[dict[int, tuple[int, ...]], dict[int, tuple[int, ...]]]:
    """For each size that a piece has, and that a piece or two have together, places of such pieces."""
    by_length: dict[int, list[int]] = {}
    for place, size in enumerate(lengths):
        by_length.setdefault(size, []).append(place)
    one = {size: (places[0],) for size, places in by_length.items()}
    two, sizes = dict(one), sorted(by_length)
    for i, a in enumerate(sizes):
        for b in sizes[i:]:
            if a != b or len(by_length[a]) > 1:
                two.setdefault(a + b, (by_length[a][0], by_length[b][a == b]))
    return one, two


def at_most(sizes: dict[int, tuple[int, ...]], limit: int) -> np.ndarray:
    """For each number up to ``limit``, the largest of ``sizes`` that isn't above it, else 0."""
    table = np.zeros(limit + 1, np.int64)
    known = [s for s in sizes if s <= limit]
    table[known] = known
    return np.maximum.accumulate(table)


def local_search(lengths: np.ndarray, bins: list[list[int]], capacity: int) -> list[list[int]]:
    """Empties bins by moves and by one-for-one and two-for-one exchanges with other bins.

    In each round every bin is visited, the emptiest first. Each step makes, of all changes that move tokens out of the
    visited bin, the one that raises the sum of squared fills most: as that gain rises with the
    tokens moved, the largest group that fits is the best one for each partner. The sum is an
    integer with a ceiling, so the search ends: when no bin has a change left that raises it, or
    when the number of bins meets the bound ``ceil(total / capacity)``.
    """
    lengths = lengths.astype(np.int64)
    bound = math.ceil(int(lengths.sum()) / capacity) if len(lengths) else 0
    members = [list(b) for b in bins]
    where = np.zeros(len(lengths), np.int64)
    for b, own in enumerate(members):
        where[own] = b
    fill = np.bincount(where, lengths, len(bins)).astype(np.int64) if len(bins) else np.zeros(0, np.int64)
    left, changed = len(bins), True
    while changed and left > bound:
        changed = False
        waiting = fill > 0
        while left > bound and waiting.any():
            low = int(np.where(waiting, fill, capacity + 1).argmin())
            waiting[low] = False
            while members[low] and fill[low] < capacity and left > bound:
                one, two = exchange_sizes([int(lengths[i]) for i in members[low]])
                own = int(fill[low])
                space = capacity - fill
                space[low] = 0
                open_bins = np.flatnonzero((space > 0) & (fill > 0))
                if not len(open_bins):
                    break
                moved = at_most(one, capacity)[space[open_bins]]
                move_gain = 2 * moved * (fill[open_bins] - own + moved)
                docs = np.flatnonzero(space[where] > 0)
                at, size = where[docs], lengths[docs]
                taken = at_most(two, 2 * capacity)[size + space[at]]
                d = taken - size
                swap_gain = np.where(d > 0, 2 * d * (fill[at] - own + d), 0)
                m, x = int(move_gain.argmax()), int(swap_gain.argmax()) if len(docs) else -1
                if max(int(move_gain[m]), int(swap_gain[x]) if x >= 0 else 0) <= 0:
                    break
                if x < 0 or move_gain[m] >= swap_gain[x]:
                    group, target, back = one[int(moved[m])], int(open_bins[m]), None
                else:
                    group, target, back = two[int(taken[x])], int(at[x]), int(docs[x])
                for i in [members[low][k] for k in group]:
                    members[low].remove(i)
                    members[target].append(i)
                    where[i] = target
                if back is not None:
                    members[target].remove(back)
                    members[low].append(back)
                    where[back] = low
                fill[target], fill[low] = lengths[members[target]].sum(), lengths[members[low]].sum() if members[low] else 0
                changed = True
            left -= not members[low]
    return [sorted(own, key=lambda i: (-lengths[i], i)) for own in members if own]


def pack(pieces: DataFrame, *, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """``sequence_id`` and ``offset`` for each piece; ``pieces`` must be stable on rereading."""
    count = pieces.count()
    shards = max(1, math.ceil(count / shard_pieces))
    columns = pieces.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [x for x in batches if x.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held)
        lengths = rows.column("length").to_numpy()
        base = TaskContext.get().partitionId() << 32
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        for b, members in enumerate(local_search(lengths, best_fit(lengths, capacity), capacity)):
            ends = np.cumsum(lengths[members])
            sequence[members] = base + b
            offset[members] = ends - lengths[members]
        rows = rows.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))
        yield from rows.to_batches(max_chunksize=10_000)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id long, offset long"
    return pieces.select(*columns).repartition(shards).mapInArrow(trimmed(place), schema)


def pack_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their places; one row per piece."""
    pieces = stored(token_pieces(docs, id_col=id_col, text_col=text_col, tokenizer=tokenizer, capacity=capacity, keep_ids=keep_ids), "pieces")
    return pack(pieces, capacity=capacity)
