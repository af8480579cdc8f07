"""Auxiliary texts in long form, resolved to the canonical record."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.functions.text import blank_to_null, stripped

# Kinds in their order, and the short fields that come along.
KINDS = ("syllabus", "headnotes", "summary", "headmatter", "arguments", "disposition", "history", "procedural_history")
META_FIELDS = ("case_name_full", "attorneys", "judges")


def long_form(rows: DataFrame, key: str, kinds: tuple[str, ...] = KINDS) -> DataFrame:
    """``key, kind, ord, char_count, raw_text``: a row for each text that isn't blank."""
    parts = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(i).alias("ord"), blank_to_null(k).alias("raw_text")) for i, k in enumerate(kinds)])
    spread = rows.select(key, F.explode(parts).alias("p")).where("p.raw_text IS NOT NULL")
    return spread.select(key, "p.kind", "p.ord", F.length("p.raw_text").cast("long").alias("char_count"), "p.raw_text")


def meta_rows(rows: DataFrame, key: str, fields: tuple[str, ...] = META_FIELDS) -> DataFrame:
    """The short fields, stripped, empty as null; rows without any are left out."""
    out = rows.select(key, *[stripped(f).alias(f) for f in fields])
    return out.where(F.coalesce(*fields).isNotNull())


def canonical_pointers(labels: DataFrame) -> DataFrame:
    """``cluster_id, canonical_cluster_id``: a duplicate's target if it has one, else the record itself."""
    target = F.when((F.col("dedup_role") == "duplicate") & F.col("dup_of").isNotNull(), F.col("dup_of")).otherwise(F.col("cluster_id"))
    return labels.select("cluster_id", target.alias("canonical_cluster_id"))


def kinds_manifest(texts: DataFrame, key: str) -> DataFrame:
    """``key, kinds, total_chars``: kinds in their order, joined by semicolons."""
    grouped = texts.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("ord", "kind"))).alias("k"), F.sum("char_count").alias("total_chars"))
    return grouped.select(key, F.array_join(F.transform("k", lambda x: x["kind"]), ";").alias("kinds"), "total_chars")


def build(raw: DataFrame, pointers: DataFrame | None = None) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """Texts and short fields of records in the corpus, and counts; without pointers all are in it."""
    rows = raw.withColumn("cluster_id", F.col("id").cast("long"))
    if pointers is None:
        kept = rows.withColumn("canonical_cluster_id", F.col("cluster_id"))
    else:
        kept = rows.join(pointers, "cluster_id")
    texts = long_form(kept, "cluster_id").join(kept.select("cluster_id", "canonical_cluster_id"), "cluster_id")
    metas = meta_rows(kept, "cluster_id")
    found = {f"kind_{r[0]}": r[1] for r in texts.groupBy("kind").count().collect()}
    n, spread = texts.agg(F.count(F.lit(1)), F.count_distinct("cluster_id")).first()
    return texts, metas, found | {"n_texts": n, "n_clusters_with_text": spread, "n_meta": metas.count(), "n_skipped": rows.count() - kept.count()}
