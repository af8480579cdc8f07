"""Parents and children: normalised records, links, and what breaks them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.functions import records as R
from lexmill.functions.text import blank_to_null
from lexmill.plans.checks import require_empty

# The text fields of a child, in the order in which they are looked at.
TEXT_FIELDS = ("html_lawbox", "xml_harvard", "html", "html_columbia", "html_anon_2020", "html_with_citations", "plain_text")


def normalize_parents(raw: DataFrame) -> DataFrame:
    """One row per parent: names, first citation, stripped citations, declared children."""
    cite = R.first_citation("citations")
    return raw.withColumn("cite_", cite).select(
        F.col("id").cast("long").alias("cluster_id"), "case_name", F.nullif("case_name_full", F.lit("")).alias("case_name_full"), "date_filed",
        F.col("cite_.volume").alias("us_volume"), F.col("cite_.page").alias("us_page"), F.col("cite_.cite").alias("us_cite"),
        F.nullif("scdb_id", F.lit("")).alias("scdb_id"), "source", "citation_count", "precedential_status",
        R.clean_citations("citations").alias("citations"), R.declared_children("sub_opinions").alias("declared_ids"),
    )


def normalize_children(raw: DataFrame) -> DataFrame:
    """One row per child: its parent's id and its texts, blank ones as null, others verbatim."""
    texts = [(blank_to_null(k) if k in raw.columns else F.lit(None).cast("string")).alias(f"source_{k}") for k in TEXT_FIELDS]
    return raw.select(
        F.col("id").cast("long").alias("opinion_id"), R.parent_of("cluster_id", "cluster").alias("cluster_id"), "type",
        F.nullif("author_str", F.lit("")).alias("author"), F.coalesce("extracted_by_ocr", F.lit(False)).alias("is_ocr_extracted"), "ordering_key", *texts,
    )


def child_counts(parents: DataFrame, children: DataFrame, parent_key: str, child_key: str, child_id: str, name: str = "n_children") -> DataFrame:
    """``parents`` with the number of distinct children of each, 0 where there are none."""
    counts = children.groupBy(F.col(child_key).alias(parent_key)).agg(F.count_distinct(child_id).alias(name))
    return parents.join(counts, parent_key, "left").withColumn(name, F.coalesce(name, F.lit(0)).cast("long"))


def orphans(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Children whose parent isn't there (a null key has none)."""
    return children.join(parents.select(F.col(parent_key).alias(child_key)), child_key, "left_anti")


def undelivered(parents: DataFrame, children: DataFrame, parent_id: str, declared: str, child_id: str) -> DataFrame:
    """Declared children that aren't there: parent and child ids."""
    asked = parents.select(parent_id, F.explode(declared).alias(child_id)).distinct()
    return asked.join(children.select(child_id), child_id, "left_anti").select(parent_id, child_id)


def to_fetch(parents: DataFrame, children: DataFrame, parent_id: str, declared: str, child_id: str) -> DataFrame:
    """Parents whose children have to be fetched: none is declared, or one isn't there yet."""
    missing = undelivered(parents, children, parent_id, declared, child_id).select(parent_id).distinct()
    return parents.where(F.size(declared) == 0).select(parent_id).union(missing).distinct()


def link(parents: DataFrame, children: DataFrame) -> DataFrame:
    """Parents with ``n_opinions``; raises if a child has no parent or a declared child is absent.

    Children that no parent declares are fine.
    """
    require_empty(orphans(children, parents, "cluster_id", "cluster_id").select("opinion_id", "cluster_id"), "children without a parent", "opinion_id")
    require_empty(undelivered(parents, children, "cluster_id", "declared_ids", "opinion_id"), "declared children that are absent", "cluster_id", "opinion_id")
    return child_counts(parents, children, "cluster_id", "cluster_id", "opinion_id", "n_opinions")
