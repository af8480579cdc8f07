"""Stages against brute force, and the whole pipeline."""

import zlib

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from lexmill.llm import queries as q
from tests.llm.test_decontaminate import slow as similarity
from tests.llm.test_langid import SlowModel
from tests.llm.test_near_copies import slow_kept
from tests.llm.test_packing import check as check_packing
from tests.llm.test_secrets import slow as slow_secrets

DIR = "/root/testdata/sf0.001"
BATCHES = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ids(df):
    return sorted(r.doc_id for r in df.collect())


def test_each_stage_by_its_own_input(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = {r.doc_id: (r.lang_pred, r.score) for r in q.op4_language_id(spark, DIR).collect()}
    kept = pipeline.language_id(spark, docs, DIR)
    assert kept.columns == docs.columns
    assert ids(kept) == sorted(i for i, _ in rows if found[i][0] != "und" and found[i][1] >= 0.5)

    kept = pipeline.simhash_near_dedup(spark, docs, DIR)
    assert kept.columns == docs.columns and ids(kept) == slow_kept(rows)

    items = [r.text for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()]
    words = [set(t.split()) for t in items]
    near = lambda t: any(len(w & set(t.split())) >= len(w) / 2 and similarity(t, i) >= 0.8 for i, w in zip(items, words))
    kept = pipeline.benchmark_decontamination(spark, docs, DIR)
    clean = sorted(i for i, t in rows if not near(t))
    assert kept.columns == docs.columns and ids(kept) == clean and len(clean) < len(rows)

    kept = pipeline.secret_scans(spark, docs, DIR)
    clean = sorted(i for i, t in rows if not slow_secrets(t)[4])
    assert kept.columns == docs.columns and ids(kept) == clean


def test_odd_rows(spark):
    text = "the same words again and again in a text of some length "
    rows = [(1, None), (2, ""), (3, text), (3, text), (4, text), (None, text), (5, "token = abcdefgh12")]
    df = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(str(r.doc_id) for r in pipeline.simhash_near_dedup(spark, df, DIR).collect()) == ["1", "3", "5", "None"]
    assert sorted(str(r.doc_id) for r in pipeline.language_id(spark, df, DIR).collect()) == ["3", "3", "4", "5", "None"]
    assert len(pipeline.secret_scans(spark, df, DIR).collect()) == 6
    for _, stage in pipeline.STAGES:
        assert stage(spark, df.limit(0), DIR).collect() == []


def slow_run(docs, items):
    """Rows (id, text, language) that the filtering stages keep, by plain means, stage after stage."""
    learnt = [(t, k) for i, t, k in docs if zlib.crc32(str(i).encode()) % 5 and t is not None and k is not None]
    model = SlowModel(learnt)
    rows = [(i, t) for i, t, _ in docs if (found := model.label(t or ""))[0] != "und" and found[1] >= pipeline.LEAST_SCORE]
    first = set(slow_kept(rows))
    rows = [(i, t) for i, t in rows if i in first]
    words = [set(t.split()) for t in items]
    near = lambda t: any(len(w & set(t.split())) >= len(w) / 2 and similarity(t, x) >= 0.8 for x, w in zip(items, words))
    return [(i, t) for i, t in rows if not near(t) and not slow_secrets(t)[4]]


def test_run_is_what_plain_stages_give(spark):
    docs = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{DIR}/documents.parquet").collect()]
    items = [r.text for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()]
    kept, batch_rows = slow_run(docs, items), spark.conf.get(BATCHES)
    found = pipeline.run(spark, DIR)
    assert spark.conf.get(BATCHES) == batch_rows
    rows = found.collect()
    assert {r.doc_id for r in rows} == {i for i, _ in kept} and 0 < len(kept) < len(docs)
    sequences = check_packing(rows, kept, Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")))
    assert sequences <= -(-sum(r.length for r in rows) // 2048) + 1


CLASHING = ["text_", "found", "count", "component_id", "row", "mark", "group_id", "fp", "a.b", "item_id", "score"]


def test_clashing_columns_and_repeated_ids_in_every_stage(spark):
    en = "the old house near the water of the town with many people and a river "
    rows = [(1, en), (2, en), (2, "another text of the same id that has its own words"), (2, en), (3, None), (None, en), (4, ""), (5, en + "token = abcdefgh12")]
    more = ["v"] * len(CLASHING)
    df = spark.createDataFrame([(*r, "en", "s", 1, *more) for r in rows], f"doc_id long, text string, lang string, source string, n_chars long, {', '.join(f'`{c}` string' for c in CLASHING)}")
    for name, stage in pipeline.STAGES[:-1]:
        got = stage(spark, df, DIR)
        assert got.columns == df.columns, name
        assert all(tuple(r)[5:] == tuple(more) for r in got.collect()), name
    left = sorted((str(r.doc_id), r.text or "") for r in pipeline.simhash_near_dedup(spark, df, DIR).collect())
    assert left == sorted([("1", en), ("2", rows[2][1]), ("3", ""), ("5", rows[7][1]), ("None", en)])
    assert {r.doc_id for r in pipeline.best_fit_packing(spark, df, DIR).collect()} == {1, 2, 3, 4, 5, None}
