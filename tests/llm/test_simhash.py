"""SimHash groups against brute force."""

import random

import numpy as np
import pytest
import xxhash

from lexmill.llm.simhash import fingerprint, near_duplicates, trie_links


def slow_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints):
    ids = sorted(prints)
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if bin(prints[a] ^ prints[b]).count("1") <= 2 and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    return label


TEXTS = [None, "", "a", "a b", "A b  c", "a B\tc", "É é \x1c x y", " ".join("w%d" % i for i in range(300)), " ".join("w%d" % i for i in range(301))]


def test_fingerprint_matches_definition():
    for text in TEXTS:
        assert fingerprint((text or "").encode()) == slow_fingerprint(text)


@pytest.mark.parametrize("size", [1, 50, 400])
def test_trie_finds_all_pairs(size):
    rng = np.random.default_rng(size)
    base = rng.integers(0, 1 << 63, 8, dtype=np.uint64)
    flips = np.array([sum(1 << int(b) for b in rng.choice(64, 3)) & (1 << 64) - 1 for _ in range(size)], np.uint64)
    fp = np.unique(base[rng.integers(0, 8, size)] ^ flips)
    got = {(int(a), int(b)) for i, j in trie_links(fp, None, 2) for a, b in zip(i, j)}
    want = {(a, b) for a in range(len(fp)) for b in range(a + 1, len(fp)) if bin(int(fp[a] ^ fp[b])).count("1") <= 2}
    assert got == want
    left, right = fp[::2], fp[1::2]
    got = {(int(a), int(b)) for i, j in trie_links(left, right, 2) for a, b in zip(i, j)}
    assert got == {(a, b) for a in range(len(left)) for b in range(len(right)) if bin(int(left[a] ^ right[b])).count("1") <= 2}


@pytest.mark.parametrize("part_rows", [50_000, 7])
def test_groups_match_brute_force(spark, part_rows):
    rnd = random.Random(3)
    base = [" ".join(rnd.choice("abcdefgh") + str(rnd.randrange(40)) for _ in range(rnd.choice([2, 30, 400]))) for _ in range(12)]
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    for i in range(9, 120):
        words = rnd.choice(base).split()
        for _ in range(rnd.choice([0, 0, 1, 2])):
            words[rnd.randrange(len(words))] = "x%d" % rnd.randrange(5)
        rows.append((i, " ".join(words)))
    rows.append(rows[20])
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, fp string")
    got = sorted((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in near_duplicates(df, part_rows=part_rows).collect())
    prints = {i: slow_fingerprint(t) for i, t in rows}
    label = slow_components(prints)
    assert got == sorted((i, prints[i], label[i]) for i, _ in rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(df).collect() == []
