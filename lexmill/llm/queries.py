"""The thin queries ``opN_<name>`` over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's secrets: counts by pattern, a digest of their spans, and all spans."""
    from .secrets import KINDS, count_of, scan, spans_text

    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", *[count_of("found", k).alias(f"n_{k}") for k, *_ in KINDS],
        F.sha2(spans_text("found", len(KINDS)), 256).alias("base_sha256"), spans_text("found").alias("spans"),
    )


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's measures and the verdict of the rule cascade."""
    from .quality_rules import judge

    found = judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and the smallest document that its links reach."""
    from .simhash import near_duplicates

    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language and the spans of languages in it, as ``lang:start:end`` by code points,
    learnt from the documents that aren't held out."""
    from .langid import fit, identify

    docs = table(spark, sf_dir, "documents")
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    found = identify(docs, fit(docs.where(fold != 0)))
    spans = F.array_join(F.transform("spans", lambda x: F.concat_ws(":", x["lang"], x["start"], x["end"])), ",")
    return found.select("doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"), spans.alias("spans"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log probability under Katz backoff and under a smoothed unigram base."""
    from .katz import score

    return score(table(spark, sf_dir, "documents"), F.crc32(F.col("doc_id").cast("string")) % 7 == 2)


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, with the item and the similarity."""
    from .decontaminate import leaks

    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality, learnt from labels that aren't held out."""
    from .quality_classifier import fit, score

    docs = table(spark, sf_dir, "documents")
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    found = score(docs, fit(docs, table(spark, sf_dir, "labels"), usable=fold != 0))
    return found.select("doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record, written to dictionary-compressed archives and read back."""
    from .warc import archive, read_archives

    return read_archives(archive(spark, table(spark, sf_dir, "pages")))


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, formatted and read back."""
    from .chat import conversations_with_probe, format_turns, read_back

    return read_back(format_turns(conversations_with_probe(table(spark, sf_dir, "conversations"))))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token pieces with the sequence and offset that hold them."""
    from .packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"))


def op11_vector_code_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable vector's product code and errors, under codebooks learnt from all of them."""
    from .vector_codes import vector_codes

    return vector_codes(table(spark, sf_dir, "embeddings"))


def op12_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of rebuilt conversations, with its rollups."""
    from .prefix_trie import prefix_trie

    return prefix_trie(table(spark, sf_dir, "conversations"))


def op13_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's words and how many of them a mixture of its source's weight takes."""
    from .mixing import mix

    return mix(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for k, v in globals().items() if k.startswith("op") and callable(v)}


def oracle_sql() -> dict[str, str]:
    from .oracles import oracle_sql

    return oracle_sql()
