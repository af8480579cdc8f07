"""Near copies of the pipeline's stage against brute force."""

import random

import corpus_pipeline as pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def slow_set(text):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def slow_kept(rows):
    """The smallest id of each group of sets with a Jaccard similarity of 0.8."""
    rows = sorted(rows)
    sets = [slow_set(t) for _, t in rows]
    root = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            n = len(sets[a] & sets[b])
            if 5 * n >= 4 * (len(sets[a]) + len(sets[b]) - n) and root[a] != root[b]:
                low, high = sorted((root[a], root[b]))
                root = [low if x == high else x for x in root]
    return sorted({rows[r][0] for r in root})


def kept(spark, rows):
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA)
    return sorted(r.doc_id for r in pipeline.simhash_near_dedup(spark, df, "").collect())


def test_near_copy_of_many_bits(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("doc_id IN (2, 56)").collect()}
    assert kept(spark, docs.items()) == [2]


def test_random_edits(spark):
    rnd = random.Random(8)
    line = " ".join("licence%d" % i for i in range(12))
    base = [" ".join("w%d" % rnd.randrange(3000) for _ in range(rnd.choice([1, 4, 5, 6, 40, 200]))) + rnd.choice(["", " " + line]) for _ in range(25)]
    rows = [(0, None), (1, ""), (2, " \t"), (3, line), (4, line.upper())]
    for i in range(5, 260):
        words = rnd.choice(base).split()
        for _ in range(rnd.choice([0, 1, 2, 3, 4, 6])):
            words[rnd.randrange(len(words))] = "x%d" % rnd.randrange(50)
        rows.append((i, " ".join(words)))
    want = slow_kept(rows)
    assert 20 < len(want) < 240 and kept(spark, rows) == want


def test_repeated_ids_and_clashing_columns(spark):
    names = "mark string, row string, set_id string, group_id string, `a.b` string, component_id int, node int, n int, h int, first boolean"
    a, b = "one two three four five six seven eight", "other words stand in this row of the same id"
    rows = [(2, a), (5, a), (5, b), (5, b), (7, b), (None, a), (None, a), (8, None), (9, "")]
    df = spark.createDataFrame([(i, t, "en", "s", 1, *"vwxyz", 1, 2, 3, 4, True) for i, t in rows], f"{SCHEMA}, {names}")
    got = pipeline.simhash_near_dedup(spark, df, "")
    assert got.columns == df.columns
    assert sorted((str(r.doc_id), r.text) for r in got.collect()) == sorted([("2", a), ("5", b), ("None", a), ("None", a), ("8", None)], key=lambda x: (x[0], x[1]))
    assert {tuple(r)[5:] for r in got.collect()} == {(*"vwxyz", 1, 2, 3, 4, True)}


def test_unrelated_texts_of_one_id_stay_apart(spark):
    from lexmill.llm.simhash import near_duplicates

    df = spark.createDataFrame([(1, "a b c"), (9, "a b c"), (9, "x y z"), (4, "x y z"), (None, "x y z")], "doc_id long, text string")
    assert sorted((str(r.doc_id), r.component_id) for r in near_duplicates(df).collect()) == [("1", 1), ("4", 4), ("9", 1), ("9", 4), ("None", 4)]
