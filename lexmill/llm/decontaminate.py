"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact check.

Each document is scanned once, as arrays over its bytes. For every size that an item has, windows of
that many shingles get a SimHash fingerprint, from running counts of set bits; windows without any
shingle of any item are passed over, since they can't be similar to one. Fingerprints are cut into
``BLOCKS`` blocks of bits. Two of them within ``radius`` bits agree in one block but for
``radius // BLOCKS`` bits, so an item stands in a table under every (block, value) that near to its
own, and looking up a window's blocks finds all items within the radius: these are the candidates,
wherever they come from in the text. Of many items each stands under fewer values, and windows are
looked up under the flips that this leaves, so that the table's size is bounded and it finds the
same. Around each candidate, windows are checked by the exact
weighted similarity of their word shingles: each weighs as often as it occurs, and the sum of the
smaller weights is taken over that of the larger.

Items are the stated query set. They are stored in the shared folder, from which workers read them;
no shuffle moves texts. A worker holds the items of one block: 12 bytes for each of their shingles, and the
bounded tables. Items beyond ``BLOCK_BYTES`` make more blocks, each one pass over the documents. The
driver holds their number alone.

Defined results: words are folded (ASCII case, punctuation at their ends); a null or empty text and
an item without words match nothing; an item of fewer than five words is one shingle; repeated
documents or items give repeated rows; ties go to the earliest window; empty tables and extra
columns are fine.
"""

from __future__ import annotations

import functools
import math
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import xxhash
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .shared import byte_slices, filtered, shared_path, stored, trimmed
from .warc import filesystem

SHINGLE_WORDS = 5
SIMILARITY = 0.8
#: Differing bits up to which windows are candidates, and blocks of bits that are looked up. Windows
#: of 0.8 similarity differ in about 9 bits, with a deviation of about 3; those next to them, which
#: make candidates too, in hardly more.
RADIUS, BLOCKS, BLOCK_BITS = 15, 4, 16
#: Bytes of item texts in one pass over the documents.
BLOCK_BYTES = 32_000_000
#: Entries of all tables of a block's fingerprints, unless there are more items than a fourth of them.
TABLE_KEYS = 4_000_000
#: Lookups, and candidates, that are compared at once.
LOOKUPS = 1_000_000
SLICE_BYTES = 400_000
#: Shingles of which window fingerprints are held at once.
RANGE_SHINGLES = 50_000
MIX = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Byte classes: 0 white space, 1 ASCII punctuation, 2 anything else.
CLASS = np.full(256, 2, np.uint8)
CLASS[[9, 10, 11, 12, 13, 32]] = 0
CLASS[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 1
PUNCTUATION = bytes(np.flatnonzero(CLASS == 1).astype(np.uint8))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


@functools.lru_cache(maxsize=1)
def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64, and of its inverse there."""
    base = int(MIX) | 1
    return tuple(np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(size, np.uint64(x))))) for x in (base, pow(base, -1, 1 << 64)))


def word_hashes(buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of each folded word in ``buffer``, all by array operations."""
    kind = CLASS[buffer]
    edge = np.diff((kind > 0).astype(np.int8), prepend=0, append=0)
    first, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    # the ends move inwards to the first and last byte that isn't punctuation
    core = np.flatnonzero(kind == 2)
    a, b = np.searchsorted(core, first), np.searchsorted(core, end)
    has = b > a
    first, end = core[a[has]], core[b[has] - 1] + 1
    # differences of polynomial prefix sums, moved to a common power, are hashes of the words
    up, down = powers(1 << max(19, int(len(buffer)).bit_length()))
    prefix = np.zeros(len(buffer) + 1, np.uint64)
    np.cumsum((LOWER[buffer].astype(np.uint64) + np.uint64(1)) * up[: len(buffer)], out=prefix[1:])
    return mixed((prefix[end] - prefix[first]) * down[first]), first


def long_word_hash(word: bytes) -> np.ndarray:
    """``word_hashes`` of one word of any length, piece by piece."""
    core = word.strip(PUNCTUATION)
    up, _ = powers(1 << 19)
    total, factor = np.zeros(1, np.uint64), np.ones(1, np.uint64)
    for i in range(0, len(core), 1 << 18):
        part = LOWER[np.frombuffer(core[i : i + (1 << 18)], np.uint8)].astype(np.uint64) + np.uint64(1)
        total += factor * (part * up[: len(part)]).sum(dtype=np.uint64)
        factor *= up[len(part)]
    return mixed(total[: bool(core)])


def long_text_hashes(text: bytes) -> np.ndarray:
    """Hashes of the words of a text of any length; a slice is long only if a word in it is."""
    out = []
    for part in byte_slices(text, SLICE_BYTES):
        if len(part) <= 2 * SLICE_BYTES:
            out.append(word_hashes(np.frombuffer(part, np.uint8))[0])
        else:
            out += [long_word_hash(w) for w in part.split()]
    return np.concatenate(out)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """One hash for each run of ``size`` words."""
    count = len(words) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(count, np.uint64)
    for k in range(size):
        total = mixed(total * np.uint64(31) + words[k : k + count] + np.uint64(k))
    return total


def bits_of(hashes: np.ndarray) -> np.ndarray:
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def running_bits(hashes: np.ndarray) -> np.ndarray:
    """How often each bit is set in the first 0, 1, 2, ... of ``hashes``."""
    running = np.zeros((len(hashes) + 1, 64), np.int32)
    np.cumsum(bits_of(hashes), axis=0, out=running[1:])
    return running


def window_prints(running: np.ndarray, size: int) -> np.ndarray:
    """SimHash of every run of ``size`` shingles, from their running bits."""
    set_bits = 2 * (running[size:] - running[:-size]) > size
    return np.packbits(set_bits, axis=1, bitorder="little").view(np.uint64).ravel()


def run_prints(hashes: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """SimHash of the runs of ``size`` shingles at ``starts``."""
    out, step = [], max(1, RANGE_SHINGLES // size)
    for i in range(0, len(starts), step):
        at = starts[i : i + step, None] + np.arange(size)
        counts = bits_of(hashes[at].ravel()).reshape(len(at), size, 64).sum(axis=1, dtype=np.int64)
        out.append(np.packbits(2 * counts > size, axis=1, bitorder="little").view(np.uint64).ravel())
    return np.concatenate(out)


@functools.lru_cache(maxsize=4)
def flips(most: int) -> np.ndarray:
    """All values of a block with at most ``most`` bits."""
    values = np.arange(1 << BLOCK_BITS, dtype=np.uint32)
    return values[np.bitwise_count(values) <= most]


def block_values(prints: np.ndarray) -> np.ndarray:
    """A row for each print: its blocks' values, with the block's number above them."""
    shifts = np.arange(BLOCKS, dtype=np.uint64) * np.uint64(BLOCK_BITS)
    values = (prints[:, None] >> shifts) & np.uint64((1 << BLOCK_BITS) - 1)
    return values.astype(np.uint32) | (np.arange(BLOCKS, dtype=np.uint32) << np.uint32(BLOCK_BITS))


def own_flips(prints: int, radius: int, table_keys: int) -> int:
    """How many bits of a block the table's side flips, for ``prints`` fingerprints in all."""
    fitting = (n for n in range(radius // BLOCKS, 0, -1) if prints * BLOCKS * len(flips(n)) <= table_keys)
    return next(fitting, 0)


class BlockTable:
    """Fingerprints by their blocks: finds all within ``radius`` bits of others.

    Up to ``flipped`` bits of a block are flipped here, those that are left of ``radius // BLOCKS``
    in the fingerprints that are looked up; all of them here if it isn't given.
    """

    def __init__(self, prints: np.ndarray, radius: int, flipped: int | None = None):
        self.prints, self.radius = prints, radius
        flipped = radius // BLOCKS if flipped is None else flipped
        near, self.asked_flips = flips(flipped), flips(radius // BLOCKS - flipped)
        keys = (block_values(prints)[:, :, None] ^ near).reshape(-1)
        order = np.argsort(keys, kind="stable")
        self.keys, self.owner = keys[order], (order // (BLOCKS * len(near))).astype(np.int32)
        self.starts = None
        if len(keys) >= 1 << BLOCK_BITS:  # places by value are smaller than the keys, and quicker
            self.starts = np.concatenate(([0], np.cumsum(np.bincount(keys, minlength=BLOCKS << BLOCK_BITS)))).astype(np.int32)
            self.keys = None

    def entries(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First entry and end of each value's."""
        if self.starts is None:
            return np.searchsorted(self.keys, asked, "left"), np.searchsorted(self.keys, asked, "right")
        return self.starts[asked].astype(np.int64), self.starts[asked + np.uint32(1)].astype(np.int64)

    def near(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of places, in ``prints`` and among the table's own, within the radius."""
        own, each = len(self.prints), BLOCKS * len(self.asked_flips)
        step, pairs = max(1, LOOKUPS // each), [np.zeros(0, np.int64)]
        for low in range(0, len(prints), step):
            asked = (block_values(prints[low : low + step])[:, :, None] ^ self.asked_flips).reshape(-1)
            first, end = self.entries(asked)
            hit = np.flatnonzero(end > first)
            first, sizes, window = first[hit], (end - first)[hit], low + hit // each
            total = np.cumsum(sizes)
            cuts = np.searchsorted(total, np.arange(LOOKUPS, int(sizes.sum()) + LOOKUPS, LOOKUPS), "right")
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(hit)], strict=True):
                if a < b:
                    pairs.append(self.compared(prints, window[a:b], first[a:b], sizes[a:b]))
        found = np.unique(np.concatenate(pairs))
        return found // own, found % own

    def compared(self, prints: np.ndarray, window: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Those candidates that are within the radius, as one number a pair."""
        at = np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
        window, own = np.repeat(window, sizes), self.owner[at]
        close = np.bitwise_count(prints[window] ^ self.prints[own]) <= self.radius
        return np.unique(window[close] * len(self.prints) + own[close])


class Items:
    """A block of benchmark items: their shingles, and tables of their fingerprints by size.

    Items of the same text are one: ``ids`` has the first's id, ``repeats`` the others'.
    """

    def __init__(self, rows: Iterable[tuple[object, bytes]], radius: int, similarity: float, table_keys: int = TABLE_KEYS):
        self.similarity = similarity
        self.ids: list[object] = []
        self.repeats: dict[int, list[object]] = defaultdict(list)
        # by width: arrays of shingles, of how many each item has, and of the items' numbers
        parts: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = defaultdict(list)
        for names, words, bounds in worded(self.distinct(rows)):
            counts = np.diff(bounds)
            for width in np.unique(np.minimum(counts[counts > 0], SHINGLE_WORDS)).tolist():
                own = np.flatnonzero(counts >= width if width == SHINGLE_WORDS else counts == width)
                sizes = counts[own] - width + 1
                at = np.repeat(bounds[own] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
                parts[width].append((shingle_hashes(words, width)[at], sizes, np.array(names)[own]))
        #: by width: all shingles in order, and those of the items as places among them
        self.known: dict[int, np.ndarray] = {}
        self.flat: dict[int, np.ndarray] = {}
        self.filters: dict[int, np.ndarray] = {}
        #: by item: width, first of its shingles and their end
        self.place = np.zeros((len(self.ids), 3), np.int32)
        self.tables: dict[tuple[int, int], tuple[np.ndarray, BlockTable]] = {}
        flipped = own_flips(sum(len(x[1]) for own in parts.values() for x in own), radius, table_keys)
        for width in sorted(parts):
            every, sizes, numbers = (np.concatenate(x) for x in zip(*parts.pop(width), strict=True))
            self.known[width] = np.unique(every)
            self.flat[width] = np.concatenate([np.searchsorted(self.known[width], every[i : i + LOOKUPS]).astype(np.int32) for i in range(0, len(every), LOOKUPS)])
            ends = np.cumsum(sizes)
            self.place[numbers] = np.stack([np.full(len(sizes), width), ends - sizes, ends], axis=1)
            bits = min(24, max(20, (4 * len(self.known[width])).bit_length()))
            self.filters[width] = np.zeros(1 << bits, bool)
            self.filters[width][self.low_bits(self.known[width], width)] = True
            for size in np.unique(sizes).tolist():
                own = np.flatnonzero(sizes == size)
                prints = run_prints(every, ends[own] - size, size)
                self.tables[width, size] = (numbers[own], BlockTable(prints, radius, flipped))

    def distinct(self, rows: Iterable[tuple[object, bytes]]) -> Iterator[tuple[int, bytes]]:
        """Number and text of each different text; ``ids`` gets its first id, ``repeats`` others."""
        seen: dict[int, int] = {}
        for key, text in rows:
            n = seen.setdefault(xxhash.xxh3_128_intdigest(text), len(self.ids))
            if n == len(self.ids):
                self.ids.append(key)
                yield n, text
            else:
                self.repeats[n].append(key)

    def low_bits(self, hashes: np.ndarray, width: int) -> np.ndarray:
        return (hashes & np.uint64(len(self.filters[width]) - 1)).astype(np.int64)

    def spots(self, hashes: np.ndarray, width: int) -> np.ndarray:
        """Where shingles of any item are."""
        at, known = np.flatnonzero(self.filters[width][self.low_bits(hashes, width)]), self.known[width]
        found = np.minimum(np.searchsorted(known, hashes[at]), len(known) - 1)
        return at[known[found] == hashes[at]]

    def bag(self, n: int) -> Counter:
        """How often an item has each of its shingles."""
        width, a, b = self.place[n].tolist()
        return Counter(self.known[width][self.flat[width][a:b]].tolist())

    def best_window(self, hashes: list[int], size: int, own: Counter) -> tuple[float, int]:
        """The highest similarity to an item's bag of a window of ``size``, and the first such window."""
        bag, low = Counter(), 0
        total = own.total()
        best = (0.0, 0)
        for i, h in enumerate(hashes):
            if h in own:
                bag[h] += 1
                low += bag[h] <= own[h]
            if i >= size and (gone := hashes[i - size]) in own:
                low -= bag[gone] <= own[gone]
                bag[gone] -= 1
            if i + 1 >= size:
                found = low / (size + total - low)
                best = max(best, (found, -(i + 1 - size)))
        return best[0], -best[1]

    def search(self, words: np.ndarray) -> Iterator[tuple[object, int, float]]:
        """Item, first word and similarity of the best window of each item found in a document."""
        best: dict[int, tuple[float, int]] = {}
        hashes = {w: shingle_hashes(words, w) for w in self.known}
        places = {w: self.spots(h, w).tolist() for w, h in hashes.items()}
        running: dict[tuple[int, int, int], np.ndarray] = {}
        for (width, size), (numbers, table) in self.tables.items():
            for low, high in merged(places[width], size, len(hashes[width])):
                part = hashes[width][low:high]
                if (width, low, high) not in running:  # whole short texts come again for each size
                    running = {(width, low, high): running_bits(part)}
                take = min(size, len(part))
                windows, found = table.near(window_prints(running[width, low, high], take))
                order = np.argsort(found, kind="stable")
                kinds, starts = np.unique(found[order], return_index=True)
                for k, at in zip(kinds.tolist(), np.split(windows[order], starts[1:]), strict=False):
                    n = int(numbers[k])
                    own = self.bag(n)
                    for a, b in merged(at.tolist(), take, len(part) - take + 1):
                        score, first = self.best_window(part[a : b + take - 1].tolist(), take, own)
                        if score >= self.similarity and (score, -(low + a + first)) > best.get(n, (0.0, 0)):
                            best[n] = (score, -(low + a + first))
        for n, (score, first) in sorted(best.items()):
            for key in (self.ids[n], *self.repeats.get(n, ())):
                yield key, -first, score


def merged(places: list[int], size: int, total: int) -> Iterator[tuple[int, int]]:
    """Ranges of shingles that hold every window of ``size`` around ``places``, cut to the text.

    Places must be in order. Ranges of windows around candidates are found the same way.
    """
    low = high = None
    for p in places:
        a, b = max(0, p - size + 1), min(total, p + size)
        if high is not None and a < high:
            high = b
        else:
            if high is not None:
                yield from stepped(low, high, size)
            low, high = a, b
    if high is not None:
        yield from stepped(low, high, size)


def stepped(low: int, high: int, size: int) -> Iterator[tuple[int, int]]:
    """A range in steps that overlap by a window less one, so that no window is lost."""
    step = max(RANGE_SHINGLES, 2 * size)
    while high - low > step:
        yield low, low + step
        low += step - size + 1
    yield low, high


def item_blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int) -> list[str]:
    """Stores the items that have a text, in blocks of about ``block_bytes``, and returns their paths."""
    items = benchmark.select(F.col(item_col).alias("item_id"), F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = math.ceil(total / block_bytes)
    if not blocks:
        return []
    path = shared_path(benchmark.sparkSession, "items")
    numbered = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    numbered.repartition("block").write.partitionBy("block").parquet(path)
    there = numbered.select("block").distinct().toLocalIterator()
    return sorted(f"{path}/block={r.block}" for r in there)


@functools.lru_cache(maxsize=1)
def read_block(path: str, radius: int, similarity: float) -> Items:
    """A block of items in a worker, kept from task to task."""
    where, place = filesystem(path)
    files = [f for f in where.get_file_info(fs.FileSelector(place)) if f.path.endswith(".parquet")]
    tables = (pq.ParquetFile(where.open_input_file(f.path)).read(["item_id", "text"]) for f in files)
    rows = ((key.as_py(), text.as_buffer().to_pybytes()) for t in tables for b in t.to_batches() for key, text in zip(b.column(0), b.column(1).cast(pa.binary()), strict=True))
    return Items(rows, radius, similarity)


def leaks(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", similarity: float = SIMILARITY, radius: int = RADIUS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, item_id, first_word, similarity``: each document that holds an item, best window.

    A window is similar from ``similarity`` on. Items come in blocks of about ``block_bytes``.
    """
    doc_type, item_type = docs.schema[id_col].dataType.simpleString(), benchmark.schema[item_col].dataType
    schema = f"doc_id {doc_type}, item_id {item_type.simpleString()}, first_word long, similarity double"

    def scanner(path: str):
        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items = read_block(path, radius, similarity)
            for batch in batches:
                found = list(batch_hits(items, batch.column(1)))
                keys = batch.column(0).take(pa.array([i for i, _ in found], pa.int64()))
                columns = list(zip(*(hit for _, hit in found), strict=True)) or [[], [], []]
                kinds = [to_arrow_type(item_type), pa.int64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([keys, *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]], ["doc_id", "item_id", "first_word", "similarity"])

        return scan

    found = None
    for path in item_blocks(benchmark, item_col, item_text_col, block_bytes):
        part = docs.select(F.col(id_col), F.col(text_col)).mapInArrow(trimmed(scanner(path)), schema)
        found = part if found is None else found.unionByName(part)
    return docs.sparkSession.createDataFrame([], schema) if found is None else found


def without_leaks(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", similarity: float = SIMILARITY, radius: int = RADIUS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no item. Of several blocks of items each but the
    last ends in a stored table, so that a task never has workers for more than one."""
    at = docs.columns.index(text_col)

    def dropper(path: str):
        def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items = read_block(path, radius, similarity)
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                clean[[i for i, _ in batch_hits(items, batch.column(at))]] = False
                yield batch.filter(pa.array(clean))

        return drop

    for i, path in enumerate(item_blocks(benchmark, item_col, item_text_col, block_bytes)):
        docs = filtered(stored(docs, "unleaked") if i else docs, dropper(path))
    return docs


def batch_hits(items: Items, texts: pa.Array) -> Iterator[tuple[int, tuple[object, int, float]]]:
    """Row and hit of each item found in a column of texts."""
    buffers = ((i, text.as_buffer()) for i, text in enumerate(texts.cast(pa.binary())) if text.is_valid)
    for rows, words, bounds in worded(buffers):
        # only texts with a shingle that some item has are searched one by one
        wanted = np.zeros(len(rows), bool)
        for width in items.known:
            wanted[np.searchsorted(bounds, items.spots(shingle_hashes(words, width), width), side="right") - 1] = True
        for k in np.flatnonzero(wanted).tolist():
            for hit in items.search(words[bounds[k] : bounds[k + 1]]):
                yield rows[k], hit


def worded(texts: Iterable[tuple[int, bytes | pa.Buffer]]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """Numbers of texts, their words' hashes and the bounds of each text's: long texts one by one, the
    words of several others in one go; empty ones are left out."""
    held, size = [], 0
    for n, text in texts:
        if len(text) > SLICE_BYTES:
            words = long_text_hashes(bytes(text))
            yield [n], words, np.array([0, len(words)])
        elif len(text):
            held.append((n, text))
            size += len(text)
        if size > SLICE_BYTES:
            yield joined(held)
            held, size = [], 0
    if held:
        yield joined(held)


def joined(held: list[tuple[int, bytes | pa.Buffer]]) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Numbers, words and bounds of several texts, hashed as one."""
    words, first = word_hashes(np.frombuffer(b" ".join(x for _, x in held), np.uint8))
    sizes = np.array([len(x) + 1 for _, x in held])
    return [n for n, _ in held], words, np.searchsorted(first, np.concatenate(([0], np.cumsum(sizes))))
