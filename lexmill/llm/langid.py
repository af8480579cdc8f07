"""Language identification of whole and mixed-language texts.

A model is a table of letter-trigram log probabilities per language. Each word (a run of letters)
gets a score per language; the script of its letters, by code-point ranges, narrows which
languages may have it; Viterbi over the words with a penalty for each switch labels spans. The
document's language is the one with most letters, its score their share.

The model learns from a bounded sample: about ``sample_docs`` documents of each language, chosen by
a hash of the id. Counts are gathered as hashed buckets, so the model's size depends on the number
of languages alone. Prediction is one Arrow pass without a shuffle. Viterbi runs over blocks of
words in lock step: transfer scores of whole blocks are chained, then each block is run from its
exact start, so long texts take no longer per word and get the exact best path. A text of many slices
is run slice by slice, and keeps a byte for each word and language for the way back.

Defined results: a text that is null or has no letter is ``und`` with score 0 and no spans, so is
any text if there was nothing to learn from; equal scores go to the first language by name;
repeated rows repeat; extra columns are ignored.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import filtered, trimmed

UNDETERMINED = "und"
BUCKET_BITS = 16
BUCKETS = 1 << BUCKET_BITS
SAMPLE_DOCS = 3000
SWITCH_PENALTY = 12.0
#: A language is a candidate for a script from this share of its letters on.
SCRIPT_SHARE = 0.01
BLOCK_WORDS = 512
SLICE_CHARS = 500_000
IMPOSSIBLE = -1e9

#: First code points of ranges and the script that starts there.
SCRIPTS = (
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"),
    (0x0600, "Arabic"), (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Gurmukhi"), (0x0A80, "Gujarati"),
    (0x0B00, "Oriya"), (0x0B80, "Tamil"), (0x0C00, "Telugu"), (0x0C80, "Kannada"), (0x0D00, "Malayalam"),
    (0x0D80, "Sinhala"), (0x0E00, "Thai"), (0x0E80, "Lao"), (0x0F00, "Tibetan"), (0x1000, "Myanmar"),
    (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x13A0, "other"), (0x1780, "Khmer"),
    (0x1800, "Mongolian"), (0x18B0, "other"), (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, "other"),
    (0x2C60, "Latin"), (0x2C80, "other"), (0x3040, "Kana"), (0x3100, "Bopomofo"), (0x3130, "Hangul"),
    (0x31F0, "Kana"), (0x3400, "Han"), (0xA000, "other"), (0xA640, "Cyrillic"), (0xA6A0, "other"),
    (0xA720, "Latin"), (0xA800, "other"), (0xAC00, "Hangul"), (0xD7B0, "other"), (0xF900, "Han"),
    (0xFB00, "Latin"), (0xFB13, "Armenian"), (0xFB1D, "Hebrew"), (0xFB50, "Arabic"), (0xFF00, "Latin"),
    (0xFF66, "Kana"), (0xFFA0, "Hangul"), (0x10000, "other"), (0x20000, "Han"), (0x32000, "other"),
)
SCRIPT_NAMES = sorted({name for _, name in SCRIPTS})


@functools.lru_cache(maxsize=1)
def characters() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By code point: the lower-case one, whether it belongs to words (1) and is a letter (2), its script."""
    every = range(0x110000)
    lower = np.fromiter((ord(x) if len(x := chr(i).lower()) == 1 else i for i in every), np.uint32, len(every))
    kind = np.fromiter(({"L": 3, "M": 1}.get(unicodedata.category(chr(i))[0], 0) for i in every), np.uint8, len(every))
    starts = np.array([a for a, _ in SCRIPTS])
    names = np.array([SCRIPT_NAMES.index(n) for _, n in SCRIPTS], np.uint8)
    return lower, kind, names[np.searchsorted(starts, np.arange(len(every)), side="right") - 1]


@dataclass
class Words:
    """Words of one or more texts: place in the joined text, letters, trigram buckets, script."""

    start: np.ndarray
    end: np.ndarray
    script: np.ndarray
    buckets: np.ndarray
    has_letter: np.ndarray


def words_of(text: str) -> Words:
    lower, kind, script = characters()
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    inside = kind[points] > 0
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    folded = np.zeros(len(points) + 2, np.uint32)
    folded[1:-1] = np.where(inside, lower[points], 0)
    at = np.flatnonzero(inside)
    h = folded[at] * np.uint32(0x9E3779B1) + folded[at + 1] * np.uint32(0x85EBCA77) + folded[at + 2] * np.uint32(0xC2B2AE3D)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    letters = np.concatenate(([0], np.cumsum(kind[points] == 3)))
    return Words(start, end, script[points[start]] if len(start) else np.zeros(0, np.uint8), h >> np.uint32(32 - BUCKET_BITS), letters[end] > letters[start])


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray  # (buckets, languages)
    allowed: np.ndarray  # (scripts, languages): 0 or IMPOSSIBLE

    def scores(self, words: Words) -> np.ndarray:
        """Log probability of each word under each language."""
        if not len(words.start):
            return np.zeros((0, len(self.langs)), np.float32)
        sizes = words.end - words.start
        first = np.cumsum(sizes) - sizes
        return np.add.reduceat(self.table[words.buckets], first, axis=0) + self.allowed[words.script]


def fit(train: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_docs: int = SAMPLE_DOCS) -> Model:
    """Learns from about ``sample_docs`` rows of each language of ``train`` (all, if there are fewer)."""
    rows = train.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    sizes = {r[0]: r[1] for r in rows.groupBy(lang_col).count().collect()}
    langs = sorted(sizes)
    if not langs:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros((len(SCRIPT_NAMES), 0), np.float32))
    share = F.coalesce(*[F.when(F.col(lang_col) == k, F.lit(min(1.0, sample_docs / sizes[k]))) for k in langs])
    chosen = rows.where(F.pmod(F.xxhash64(id_col), F.lit(1 << 20)) < share * (1 << 20))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((len(langs), BUCKETS + len(SCRIPT_NAMES)), np.int64)
        place = {k: i for i, k in enumerate(langs)}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for part in sliced(text.as_py()):
                    words = words_of(part)
                    held[place[lang], :BUCKETS] += np.bincount(words.buckets, minlength=BUCKETS)
                    held[place[lang], BUCKETS:] += np.bincount(words.script, weights=words.end - words.start, minlength=len(SCRIPT_NAMES)).astype(np.int64)
        lang, bucket = np.nonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(lang.astype(np.int32)), pa.array(bucket.astype(np.int32)), pa.array(held[lang, bucket])], ["lang", "bucket", "n"])

    counts = np.zeros((BUCKETS + len(SCRIPT_NAMES), len(langs)))
    found = chosen.select(lang_col, text_col).mapInArrow(trimmed(count), "lang int, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    counts[found.column("bucket").to_numpy(), found.column("lang").to_numpy()] = found.column("n").to_numpy()
    grams, scripts = counts[:BUCKETS], counts[BUCKETS:]
    table = np.log((grams + 0.5) / (grams.sum(axis=0) + 0.5 * BUCKETS)).astype(np.float32)
    fits = scripts / np.maximum(1, scripts.sum(axis=0)) >= SCRIPT_SHARE
    fits[~fits.any(axis=1)] = True  # a script that no language has narrows nothing
    return Model(langs, table, np.where(fits, 0, IMPOSSIBLE).astype(np.float32))


def sliced(text: str) -> Iterator[str]:
    """``text`` in slices of bounded length, cut at white space where there is some."""
    start = 0
    while len(text) - start > SLICE_CHARS:
        cut = max(text.rfind(" ", start, start + SLICE_CHARS), text.rfind("\n", start, start + SLICE_CHARS))
        cut = cut if cut > start else start + SLICE_CHARS
        yield text[start:cut]
        start = cut
    yield text[start:]


class Lattice:
    """Words of several texts with their scores: back pointers of the best paths, from given starts.

    Words lie in blocks of ``block``, which are run in lock step. ``start`` has the value of each state
    before each text's first word; ``end`` that after its last, which the text's next slice starts from.
    """

    def __init__(self, scores: np.ndarray, counts: np.ndarray, start: np.ndarray, penalty: float, block: int):
        n_lang = scores.shape[1]
        self.doc = doc = np.repeat(np.arange(len(counts)), -(-counts // block))
        self.number = number = np.arange(len(doc)) - np.searchsorted(doc, doc)
        self.begin = begin = (np.cumsum(counts) - counts)[doc] + number * block
        self.length = np.minimum(block, counts[doc] - number * block)
        self.stay = stay = np.arange(n_lang, dtype=np.int8 if n_lang < 128 else np.int16)
        last = np.append(doc[1:] != doc[:-1], True)[: len(doc)]
        # scores from each state before a block to each state at its end
        order, active = self.lanes(np.flatnonzero(~last))
        carry = np.full((len(doc), n_lang, n_lang), IMPOSSIBLE)
        carry[:, np.arange(n_lang), np.arange(n_lang)] = 0
        for t, k in enumerate(active):
            now = order[:k]
            c = carry[now]
            carry[now] = scores[begin[now] + t][:, None, :] + np.maximum(c, c.max(axis=2, keepdims=True) - penalty)
        value = start[doc].astype(float)
        for j in range(1, int(number.max(initial=0)) + 1):
            at = np.flatnonzero(number == j)
            value[at] = (value[at - 1][:, :, None] + carry[at - 1]).max(axis=1)
            value[at] -= value[at].max(axis=1, keepdims=True)
        # each block from its exact start, with the state before each word for each state at it
        order, active = self.lanes(np.arange(len(doc)))
        self.back = np.zeros((len(scores), n_lang), stay.dtype)
        for t, k in enumerate(active):
            now = order[:k]
            v = value[now]
            top = v.argmax(axis=1)
            moved = np.take_along_axis(v, top[:, None], axis=1) - penalty
            self.back[begin[now] + t] = np.where(v >= moved, stay, top[:, None])
            value[now] = scores[begin[now] + t] + np.maximum(v, moved)
        self.end = start.astype(float)
        self.end[doc[last]] = value[last] - value[last].max(axis=1, keepdims=True)

    def lanes(self, which: np.ndarray) -> tuple[np.ndarray, list[int]]:
        """Blocks by falling length, and how many are at work at each step."""
        order = which[np.argsort(-self.length[which], kind="stable")]
        sizes = self.length[order]
        return order, [int(x) for x in np.searchsorted(-sizes, -np.arange(1, int(sizes[0]) + 1), side="right")] if len(order) else []

    def labels(self, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The state of each word, given that at the end of each text, and that before each text."""
        doc, number, begin, length, back = self.doc, self.number, self.begin, self.length, self.back
        out, first = np.zeros(len(back), self.stay.dtype), last.astype(self.stay.dtype)
        if not len(doc):
            return out, first
        # states before each block for each state at its end, then the states at the ends
        order, active = self.lanes(np.flatnonzero(number > 0))
        before = np.tile(self.stay, (len(doc), 1))
        for t, k in enumerate(active):
            now = order[:k]
            before[now] = np.take_along_axis(back[begin[now] + length[now] - 1 - t], before[now], axis=1)
        state = first[doc]
        for j in range(int(number.max()), 0, -1):
            at = np.flatnonzero(number == j)
            state[at - 1] = before[at, state[at]]
        order, active = self.lanes(np.arange(len(doc)))
        for t, k in enumerate(active):
            now = order[:k]
            at = begin[now] + length[now] - 1 - t
            out[at] = state[now]
            state[now] = back[at, state[now]]
        first[doc[number == 0]] = state[number == 0]
        return out, first


def best_path(scores: np.ndarray, counts: np.ndarray, penalty: float = SWITCH_PENALTY, block: int = BLOCK_WORDS) -> np.ndarray:
    """The language of each word of several texts: the path of the highest sum of word scores
    less ``penalty`` for each switch. ``counts`` has the number of words of each text."""
    if not len(scores) or scores.shape[1] < 2:
        return np.zeros(len(scores), np.int8)
    lattice = Lattice(scores, counts, np.zeros((len(counts), scores.shape[1])), penalty, block)
    return lattice.labels(lattice.end.argmax(axis=1))[0]


@dataclass
class Labels:
    """Language (a place among the model's, or -1) and score of texts, and their spans one after
    another: how many each text has, first and end characters, languages."""

    lang: np.ndarray
    score: np.ndarray
    spans: np.ndarray
    start: np.ndarray
    end: np.ndarray
    of: np.ndarray

    @staticmethod
    def joined(parts: list[Labels]) -> Labels:
        none = Labels(*(np.zeros(0, t) for t in (np.int64, float, np.int64, np.int64, np.int64, np.int64)))
        return Labels(*(np.concatenate([getattr(p, k) for p in [none, *parts]]) for k in none.__dataclass_fields__))


def summed_up(words: list[np.ndarray], counts: np.ndarray, n_lang: int) -> Labels:
    """Languages, scores and spans from words' first and end characters, letters and labels."""
    start, end, letter, own = words
    doc = np.repeat(np.arange(len(counts)), counts)
    mass = np.bincount(doc * n_lang + own, weights=end - start, minlength=len(counts) * n_lang).reshape(-1, n_lang)
    known = np.bincount(doc, weights=letter, minlength=len(counts)) > 0
    kept = known[doc]
    doc, own, start, end = doc[kept], own[kept], start[kept], end[kept]
    begins = np.flatnonzero(np.append(True, (np.diff(doc) != 0) | (np.diff(own) != 0))[: len(doc)])
    ends = np.append(begins[1:], len(doc))[: len(begins)] - 1
    with np.errstate(invalid="ignore"):
        share = np.where(known, mass.max(axis=1) / mass.sum(axis=1), 0.0)
    spans = np.bincount(doc[begins], minlength=len(counts))
    return Labels(np.where(known, mass.argmax(axis=1), -1), share, spans, start[begins], end[ends], own[begins].astype(np.int64))


def label_texts(texts: list[str], model: Model) -> Labels:
    """Languages and spans of texts that are short together."""
    if not model.langs:
        none = np.zeros(len(texts), np.int64)
        return Labels(none - 1, none.astype(float), none, none[:0], none[:0], none[:0])
    found = [words_of(text) for text in texts]
    counts = np.array([len(w.start) for w in found], np.int64)
    own = best_path(np.concatenate([model.scores(w) for w in found]), counts)
    return summed_up([*(np.concatenate([getattr(w, k) for w in found]) for k in ("start", "end", "has_letter")), own], counts, len(model.langs))


def label_long_text(text: str, model: Model) -> Labels:
    """As ``label_texts``, for one text, slice by slice: of a slice that is done, the back pointers, a
    byte for each word and language, and the words' places are left."""
    if len(model.langs) < 2:
        return label_texts([text], model)
    held, start, offset = [], np.zeros((1, len(model.langs))), 0
    for part in sliced(text):
        words = words_of(part)
        lattice = Lattice(model.scores(words), np.array([len(words.start)]), start, SWITCH_PENALTY, BLOCK_WORDS)
        start = lattice.end
        held.append((lattice, offset, words.start.astype(np.int32), words.end.astype(np.int32), bool(words.has_letter.any())))
        offset += len(part)
    known, mass, state = any(h[4] for h in held), np.zeros(len(model.langs)), start.argmax(axis=1)
    runs: list[np.ndarray] = []  # first, end and language of runs of one language, the last slice's first
    while held:
        lattice, offset, first, end, _ = held.pop()
        own, state = lattice.labels(state)
        mass += np.bincount(own, weights=end - first, minlength=len(mass))
        begins = np.flatnonzero(np.append(True, np.diff(own) != 0)[: len(own)])
        runs.append(np.stack([first[begins] + offset, end[np.append(begins[1:], len(own))[: len(begins)] - 1] + offset, own[begins].astype(np.int64)]))
    first, end, own = np.concatenate(runs[::-1], axis=1) if known else np.zeros((3, 0), np.int64)
    begins = np.flatnonzero(np.append(True, np.diff(own) != 0)[: len(own)])
    ends = np.append(begins[1:], len(own))[: len(begins)] - 1
    share = mass.max() / mass.sum() if known else 0.0
    return Labels(np.array([mass.argmax() if known else -1]), np.array([share]), np.array([len(begins)]), first[begins].astype(np.int64), end[ends].astype(np.int64), own[begins].astype(np.int64))


def labelled(column: pa.Array, model: Model) -> Labels:
    """Labels of a column of texts, in batches of bounded length."""
    out: list[Labels] = []
    held, size = [], 0

    def settle() -> None:
        nonlocal held, size
        if held:
            out.append(label_texts(held, model))
        held, size = [], 0

    for value in column:
        text = value.as_py() or ""
        if len(text) > SLICE_CHARS:
            settle()
            out.append(label_long_text(text, model))
            continue
        held.append(text)
        size += len(text)
        if size > SLICE_CHARS:
            settle()
    settle()
    return Labels.joined(out)


def identify(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text", spans: bool = True) -> DataFrame:
    """``doc_id, lang_pred, score`` and, if wanted, ``spans`` of each row."""
    names = pa.array([*model.langs, UNDETERMINED])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = labelled(batch.column(1), model)
            columns = {"doc_id": batch.column(0), "lang_pred": names.take(pa.array(np.where(found.lang < 0, len(model.langs), found.lang))), "score": pa.array(found.score)}
            if spans:
                ends = np.concatenate(([0], np.cumsum(found.spans))).astype(np.int32)
                columns["spans"] = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([pa.array(found.start), pa.array(found.end), names.take(pa.array(found.of))], ["start", "end", "lang"]))
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, lang_pred string, score double" + ", spans array<struct<start:long,end:long,lang:string>>" * spans
    return docs.select(id_col, text_col).mapInArrow(trimmed(predict), schema)


def with_language(docs: DataFrame, model: Model, least_score: float, *, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose language is known with at least ``least_score``."""
    at = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = labelled(batch.column(at), model)
            yield batch.filter(pa.array((found.lang >= 0) & (found.score >= least_score)))

    return filtered(docs, keep)
