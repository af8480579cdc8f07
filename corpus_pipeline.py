"""The training-data pipeline: stages over ``documents``, each written and reread by the next.

Every stage but the last filters rows and keeps the columns of ``documents``:

* language ID drops documents without letters, or of which no language has half the letters;
* near-dedup keeps one document of each group of near copies, that of the smallest id: texts whose
  sets of five-word shingles have a Jaccard similarity of 0.8, linked by the SimHash trie of `op3`
  where they differ least, and by prefix filters where they differ more;
* benchmark decontamination drops documents that hold a benchmark item;
* secret scans drop documents in which a pattern or a window's entropy finds a secret;
* best-fit packing returns the token pieces of what is left, with their sequences.

Rows without an id have no place in a group of near-duplicates and pass that stage.
"""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm.decontaminate import without_leaks
from lexmill.llm.langid import fit, with_language
from lexmill.llm.near_copies import without_near_copies
from lexmill.llm.packing import pack_documents
from lexmill.llm.secrets import without_secrets
from lexmill.storage import remove, shared_path

#: The least share of letters that the language of a document has.
LEAST_SCORE = 0.5
#: Documents in one Arrow batch: Spark's 10,000 of a few kilobytes each, held by the JVM and by the
#: Python worker of every running task, are much of an executor's memory.
BATCH_ROWS = 2000


@contextlib.contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """The session's batch size, if it is larger, is ``BATCH_ROWS`` inside and what it was afterwards."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    if not 0 < int(before) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language, learnt from the documents that aren't held out."""
    learnt = docs.where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    return with_language(docs, fit(learnt), LEAST_SCORE)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest id."""
    return without_near_copies(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a secret."""
    return without_secrets(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents, packed into sequences."""
    return pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("best_fit_packing", best_fit_packing),
]

#: Learnt models and token ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``; a stage's table goes once the next one is written.

    Work on texts is done when this returns, in small batches; what is left to the caller's action is
    to place the pieces, rows of numbers. The session's settings are left as they were.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    with small_batches(spark):
        for name, stage in STAGES[:-1]:
            path = shared_path(spark, name)
            stage(spark, docs, sf_dir).write.parquet(path)
            docs = spark.read.schema(docs.schema).parquet(path)
            if before:
                remove(spark, before)
            before = path
        packed = STAGES[-1][1](spark, docs, sf_dir)
    if before:
        remove(spark, before)
    return packed
