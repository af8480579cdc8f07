"""Leaks against brute force over all windows."""

import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest

from lexmill.llm import decontaminate
from lexmill.llm.decontaminate import BlockTable, Items, block_values, leaks, long_text_hashes, long_word_hash, run_prints, running_bits, shingle_hashes, window_prints, without_leaks, word_hashes

PUNCT = "".join(chr(i) for i in range(33, 127) if not chr(i).isalnum())


def words_of(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\r\x0b\x0c":
        text = text.replace(c, " ")
    return [w for w in (x.strip(PUNCT) for x in text.split(" ")) if w]


def slow(doc, item):
    d, i = words_of(doc), words_of(item)
    if not i:
        return 0.0
    k = min(5, len(i))
    sd, si = [tuple(d[x : x + k]) for x in range(len(d) - k + 1)], [tuple(i[x : x + k]) for x in range(len(i) - k + 1)]
    best, own = 0.0, Counter(si)
    for x in range(max(1, len(sd) - len(si) + 1)):
        w = Counter(sd[x : x + len(si)])
        best = max(best, sum((w & own).values()) / sum((w | own).values()))
    return best


def test_word_hashes_follow_folding():
    text = "The the, THE. (the) dé É -- a.b 'x' \t z"
    h, _ = word_hashes(np.frombuffer(text.encode(), np.uint8))
    assert len(h) == len(words_of(text))
    assert h[0] == h[1] == h[2] == h[3] and len(set(h.tolist())) == len(set(words_of(text)))


def test_leaks_match_brute_force(spark):
    rnd = random.Random(5)
    item = lambda n: " ".join(rnd.choice("abcdefghijkl") + str(rnd.randrange(30)) for _ in range(n))
    items = [(n, item(n)) for n in (1, 3, 5, 12, 25, 40, 60, 90)] + [(200, None), (201, ""), (202, "?!")]
    docs = [(1, None, 0), (2, "", 0), (3, "x", 0)]
    for k in range(4, 160):
        words = item(rnd.choice([10, 80, 300])).split()
        if k % 2:
            copy = rnd.choice(items[2:8])[1].upper().split() if k % 5 == 0 else rnd.choice(items[2:8])[1].split()
            for _ in range(rnd.choice([0, 0, 1, 1, 2])):
                copy[rnd.randrange(len(copy))] = "zz" + str(k)
            if k % 7 == 0:
                copy.insert(len(copy) // 2, "new")
            at = rnd.randrange(len(words))
            words[at:at] = copy
        docs.append((k, " ".join(words), 0))
    docs.append(docs[5])
    d = spark.createDataFrame(docs, "doc_id long, text string, item_id int")
    b = spark.createDataFrame(items, "item_id long, text string")
    want = sorted((k, n, round(s, 9)) for k, t, _ in docs for n, i in items if (s := slow(t, i)) >= 0.8)
    for block_bytes in (8_000_000, 400):
        got = sorted((r.doc_id, r.item_id, round(r.similarity, 9)) for r in leaks(d, b, block_bytes=block_bytes).collect())
        assert got == want
    assert len(want) > 40


def test_long_text_and_empty_tables(spark):
    passage = " ".join("p%d" % i for i in range(50))
    text = ("filler words here " * 100_000) + passage + " end" * 10
    d = spark.createDataFrame([(1, text)], "doc_id long, text string")
    b = spark.createDataFrame([(7, passage)], "item_id int, text string")
    assert [(r.doc_id, r.item_id, r.first_word, r.similarity) for r in leaks(d, b).collect()] == [(1, 7, 300_000, 1.0)]
    assert leaks(d, b.limit(0)).collect() == [] and leaks(d.limit(0), b).collect() == []


@pytest.mark.parametrize(("radius", "flipped"), [(3, 0), (6, 1), (6, 0), (15, None), (15, 2), (15, 1), (15, 0)])
def test_block_tables_find_all_within_the_radius(radius, flipped):
    rng = np.random.default_rng(radius)
    own = rng.integers(0, 1 << 63, 20, dtype=np.uint64)
    own[7] = own[3]
    table = BlockTable(own, radius, flipped)
    prints = np.array([int(own[i]) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 2 * radius), replace=False)) for i in range(20) for _ in range(50)], np.uint64)
    windows, found = table.near(prints)
    got = set(zip(windows.tolist(), found.tolist(), strict=True))
    assert got == {(w, n) for w in range(len(prints)) for n in range(20) if int(prints[w] ^ own[n]).bit_count() <= radius}
    if flipped is not None:
        return
    # the blocks select: of far prints few are even compared
    far = rng.integers(0, 1 << 63, 2000, dtype=np.uint64)
    asked = block_values(far).reshape(-1)
    compared = np.searchsorted(table.keys, asked, "right") - np.searchsorted(table.keys, asked, "left")
    assert compared.sum() < 0.06 * len(far) * len(own)


def test_best_window_is_the_plain_one():
    rnd = random.Random(2)
    words = lambda n: " ".join(rnd.choice("abcd") for _ in range(n))
    for _ in range(60):
        item, doc = words(rnd.randrange(5, 14)), words(rnd.randrange(30, 60))
        items = Items([(1, item.encode())], 15, 0.8)
        hashes = shingle_hashes(long_text_hashes(doc.encode()), 5).tolist()
        assert items.best_window(hashes, len(item.split()) - 4, items.bag(0))[0] == pytest.approx(slow(doc, item))


def test_short_texts_have_no_long_shingles():
    assert len(shingle_hashes(long_text_hashes(b"a b"), 5)) == 0


def test_long_words_hash_like_others(monkeypatch):
    rnd = random.Random(1)
    for n in (0, 1, 5, (1 << 18) - 1, 1 << 18, 600_001):
        word = "".join(rnd.choice("aBz9-") for _ in range(n)).encode()
        plain, _ = word_hashes(np.frombuffer(b"(" + word + b").", np.uint8)) if n else (np.zeros(0, np.uint64), None)
        assert long_word_hash(b"(" + word + b").").tolist() == plain.tolist()
    text = b"a b " + b"x-" * 600_000 + b"y c"
    whole, _ = word_hashes(np.frombuffer(text, np.uint8))
    assert long_text_hashes(text).tolist() == whole.tolist()


def test_large_tables_are_looked_up_by_value(monkeypatch):
    rng = np.random.default_rng(4)
    own = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    own[:40] = own[0]
    prints = np.concatenate([own[:300] ^ np.uint64(0b1011), rng.integers(0, 1 << 63, 200, dtype=np.uint64)])
    want = {(w, n) for w in range(len(prints)) for n in np.flatnonzero(np.bitwise_count(own ^ prints[w]) <= 15).tolist()}
    monkeypatch.setattr(decontaminate, "LOOKUPS", 5000)
    for flipped in (1, 2, 3):
        table = BlockTable(own, 15, flipped)
        assert table.keys is None
        assert set(zip(*(x.tolist() for x in table.near(prints)), strict=True)) == want


def test_many_short_items_stay_small():
    """25,000 items of six words: the tables keep to their bound, and hits are those of a full table."""
    rnd = random.Random(3)
    rows = [(n, " ".join(f"w{rnd.randrange(20_000)}" for _ in range(6)).encode()) for n in range(25_000)]
    rows += [(-n, text) for n, text in rows[1:50]]
    tracemalloc.start()
    items = Items(rows, 15, 0.8)
    held, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert held < 60e6 and peak < 250e6, (held, peak)
    assert sum(len(t.owner) for _, t in items.tables.values()) <= decontaminate.TABLE_KEYS
    doc = b"some words before " + rows[7][1] + b" and " + rows[11][1].upper() + b" after"
    few = Items(rows[:100] + [(-7, rows[7][1]), (-11, rows[11][1])], 15, 0.8)
    got = sorted(items.search(long_text_hashes(doc)))
    assert got == sorted(few.search(long_text_hashes(doc))) and {x[0] for x in got} == {7, -7, 11, -11}


def test_item_prints_are_those_of_their_windows():
    words = long_text_hashes(" ".join(f"v{i % 7}x{i % 3}" for i in range(90)).encode())
    hashes = shingle_hashes(words, 5)
    for size in (1, 2, 20, len(hashes)):
        assert run_prints(hashes, np.arange(len(hashes) - size + 1), size).tolist() == window_prints(running_bits(hashes), size).tolist()


def test_several_blocks_drop_what_one_drops(spark):
    items = [(n, " ".join(f"b{n}w{i}" for i in range(8))) for n in range(6)]
    docs = [(n, f"lead in {items[n][1]} tail" if n < 4 else f"clean text number {n}", n) for n in range(9)]
    d, b = spark.createDataFrame(docs, "doc_id long, text string, Text2 int"), spark.createDataFrame(items, "item_id long, text string")
    for block_bytes in (10_000, 60):
        assert sorted(r.doc_id for r in without_leaks(d, b, block_bytes=block_bytes).collect()) == [4, 5, 6, 7, 8]
