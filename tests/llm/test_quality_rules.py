"""Rule measures against brute force, and the cascade's order."""

import random
import re
from collections import Counter

from pyspark.sql import functions as F

from lexmill.llm import quality_rules as q
from lexmill.llm.queries import op2_quality_rules


def slow(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    counts = Counter(zip(words, words[1:], words[2:]))
    repeated = set()
    for i, w in enumerate(zip(words, words[1:], words[2:])):
        if counts[w] > 1:
            repeated |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    chars, symbols, dups = sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines))
    bad = 10 * symbols > len(words) or 2 * chars < 5 * len(words) or chars > 12 * len(words) or 10 * dups > 3 * len(text.split("\n"))
    bad = bad or 10 * text.count("!") > 3 * len(words) or 2 * sum("A" <= c <= "Z" for c in text) > chars
    return (len(words), chars, symbols, dups, len(repeated), failed, not failed and not bad)


def rows_of(df):
    return sorted((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) for r in df.collect())


def test_odd_texts(spark):
    rnd = random.Random(2)
    texts = [None, "", " ", "\n\n", "a", "a b", "a b c", "a b c a b c", "x x x x", "É 𝒳\x0b\x0c\r\x85 \x1c q", "l\nl\n l\n\nl", "#*$%&|<>! #", "w " * 5000, " lead and trail \n"]
    texts += [" ".join(rnd.choice("abcdefgh") * rnd.randrange(1, 5) for _ in range(rnd.randrange(200))) + rnd.choice(["\n", "!", " A# "]) * rnd.randrange(30) for _ in range(150)]
    rows = [(i, t, "c") for i, t in enumerate(texts)] + [(3, "\n\n", "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, words string")
    assert rows_of(q.judge(df)) == sorted((i, *slow(t)) for i, t, _ in rows)
    assert q.judge(df.limit(0)).collect() == []


def test_names_of_columns_cannot_clash(spark):
    names = ["doc_id", "text", "Words", "words", "windows", "N_words", "kept", "Base_Failed", "row", "a.b", "Doc_ID"]
    texts = ["w " * 60, None, "a b c d " * 20 + "# " * 40]
    got = q.judge(spark.createDataFrame([(i, t, *"abcdefghi") for i, t in enumerate(texts)], names))
    assert got.columns == ["doc_id", "Words", "words", "windows", "row", "a.b", "Doc_ID", *q.ADDED]
    want = [(i, "a", "b", "c", "g", "h", "i", t or "", *slow(t)) for i, t in enumerate(texts)]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert rows_of(op2_quality_rules(spark, "/root/testdata/sf0.001")) == sorted((r.doc_id, *slow(r.text)) for r in docs)


def test_cheap_rules_that_reject_come_first(spark):
    df = spark.createDataFrame([(i, "word " * 200) for i in range(400)], "doc_id long, text string")
    slow_rule = F.length(F.repeat(F.regexp_replace("text", "(w|o)(r|x)*", "zz"), 200)) > 0
    rules = [q.Rule("never", F.col("n_words") < 0), q.Rule("dear", slow_rule), q.Rule("cheap", F.col("n_words") > 3)]
    assert [r.name for r in q.ordered_rules(df, rules)] == ["cheap", "dear", "never"]


def test_costs_are_those_of_evaluation(spark):
    df = spark.createDataFrame([(i, f"{i} " + "word " * 200) for i in range(300)], "doc_id long, text string")
    work = lambda n: F.length(F.regexp_replace(F.repeat("text", n), "(w|o)(r|x)*", "zz")) < 0
    rules = [q.Rule("little", work(1)), q.Rule("much", work(20)), q.Rule("even", F.col("n_words") % 2 == 0), q.Rule("null", F.lit(None).cast("boolean"))]
    known = q.estimates(df, rules)
    assert known["much"][0] > 5 * known["little"][0] > 5 * known["even"][0] > 0
    assert {k: v[1] for k, v in known.items()} == {"little": 0, "much": 0, "even": 0, "null": 0}
    assert q.ordered_rules(df.limit(0), rules) == rules and q.ordered_rules(df, []) == []
