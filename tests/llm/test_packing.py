"""Packing: token ids against the tokenizer, places, and the local search."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lexmill.llm import packing as p
from lexmill.llm.queries import op10_best_fit_packing

TEXTS = [None, "", " ", "A b.", "The,. cat's 'S sat. é. É, ß… ÀÖ×÷øÿ naïve.", "a\x0bb\x1cc\x85d\xa0e", "<|endoftext|>x <|startoftext|> y", "<|ENDOFTEXT|> a", "<|StartOfText|>", "A.<|EndOfText|>, b.<|endoftext|>. C<|ENDOFTEXT|><|endoftext|>d", "<|end oftext|> <|endoftext |>", "é ́x İ ΣΣ Σ", "word " * 5000, "𝒳𝒴 数 123 4.5", "x" * 3000]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_ids_are_the_tokenizers(tokenizer, monkeypatch):
    for limit in (p.SLICE_BYTES, 50):
        monkeypatch.setattr(p, "SLICE_BYTES", limit)
        for cache in (p.CACHE_WORDS, 3):
            monkeypatch.setattr(p, "CACHE_WORDS", cache)
            got = [x.tolist() for x in p.encoded([(t or "").encode() for t in TEXTS], p.WordTokens(p.TOKENIZER))]
            assert got == [x.ids for x in tokenizer.encode_batch([t or "" for t in TEXTS], add_special_tokens=False)]


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError, match="one by one"):
        p.WordTokens("byte_bpe_50k.json")


def check(rows, texts, tokenizer):
    by = defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    for i, t in texts:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        want = [(k, s, len(ids[s : s + 2048]), zlib.crc32(ids[s : s + 2048].tobytes())) for k, s in enumerate(range(0, len(ids), 2048))]
        times = sum(x == i for x, _ in texts)
        assert sorted((r.piece, r.start, r.length, r.ids_crc32) for r in by[i]) == sorted(want * times)
    fill = defaultdict(list)
    for r in rows:
        fill[r.sequence_id].append((r.offset, r.length))
    for spans in fill.values():
        spans.sort()
        assert [a for a, _ in spans] == [0, *np.cumsum([n for _, n in spans])[:-1]] and sum(n for _, n in spans) <= 2048
    return len(fill)


def test_odd_texts(spark, tokenizer):
    texts = [*enumerate(TEXTS), (4, TEXTS[4])]
    df = spark.createDataFrame([(*r, "c") for r in texts], "doc_id long, text string, piece string")
    check(p.pack_documents(df).collect(), texts, tokenizer)
    assert p.pack_documents(df.limit(0)).collect() == []
    kept = p.pack_documents(df, keep_ids=True).collect()
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in kept)


def test_table(spark, tokenizer):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rows = op10_best_fit_packing(spark, "/root/testdata/sf0.001").collect()
    assert check(rows, texts, tokenizer) <= -(-sum(r.length for r in rows) // 2048) + 1


@pytest.mark.parametrize("seed", range(4))
def test_local_search_empties_bins(seed):
    lengths = np.random.default_rng(seed).integers([500, 300, 1, 700][seed], [900, 1100, 1500, 1400][seed], 2000)
    before = p.best_fit(lengths, 2048)
    after = p.local_search(lengths, before, 2048)
    assert sorted(i for b in after for i in b) == list(range(2000))
    assert max(lengths[b].sum() for b in after) <= 2048
    assert len(after) <= len(before) and (seed == 3 or len(after) < len(before) or len(before) == -(-lengths.sum() // 2048))


@pytest.mark.parametrize(("low", "high", "most"), [(500, 900, 1454), (300, 1100, 1391)])
def test_search_has_no_caps(low, high, most):
    lengths = np.random.default_rng(0).integers(low, high, 4000)
    assert len(p.local_search(lengths, p.best_fit(lengths, 2048), 2048)) <= most


@pytest.mark.parametrize("seed", range(6))
def test_search_ends_where_no_change_helps(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, [12, 30, 60][seed % 3], 40)
    bins = p.local_search(lengths, p.best_fit(lengths, 64), 64)
    if len(bins) == -(-lengths.sum() // 64):
        return
    fill = [int(lengths[b].sum()) for b in bins]
    for x, own in enumerate(bins):
        groups = [(i,) for i in own] + [(i, j) for i in own for j in own if i < j]
        for y, other in enumerate(bins):
            for back in [None, *other]:
                for g in groups if x != y else []:
                    d = int(lengths[list(g)].sum()) - (0 if back is None else int(lengths[back]))
                    if d > 0 and fill[y] + d <= 64 and fill[x] < 64 and (back is not None or len(g) == 1):
                        assert (fill[y] + d) ** 2 + (fill[x] - d) ** 2 <= fill[y] ** 2 + fill[x] ** 2


def test_ties_and_equal_lengths():
    lengths = np.full(1000, 700)
    assert len(p.local_search(lengths, p.best_fit(lengths, 2048), 2048)) == 500
    lengths = np.ones(5000, np.int64)
    assert len(p.local_search(lengths, p.best_fit(lengths, 2048), 2048)) == 3
