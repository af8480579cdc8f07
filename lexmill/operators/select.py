"""Choosing one text per record by priority."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions.text import is_dirty

# Source fields, the preferred first.
SOURCE_PRIORITY = ("source_html_lawbox", "source_xml_harvard", "source_html", "source_html_with_citations")
FIRST_VOLUME, LAST_VOLUME = 2, 18


def filled(name: str) -> Column:
    return F.col(name).isNotNull() & (F.col(name) != "")


def chosen_name(fields: tuple[str, ...] = SOURCE_PRIORITY) -> Column:
    """Name of the first field that isn't empty; null if all are."""
    return F.coalesce(*[F.when(filled(f), F.lit(f)) for f in fields])


def chosen_text(fields: tuple[str, ...] = SOURCE_PRIORITY) -> Column:
    return F.coalesce(*[F.when(filled(f), F.col(f)) for f in fields])


def longest_text(fields: tuple[str, ...]) -> Column:
    """The longest of the fields' texts; of equally long ones, that of the first field."""
    ranked = F.array(*[F.struct(F.coalesce(F.length(f), F.lit(0)).alias("n"), F.lit(-i).alias("o"), F.col(f).alias("t")) for i, f in enumerate(fields)])
    return F.array_max(ranked)["t"]


def longest_child(children: DataFrame, parent: str, child: str, text: str) -> DataFrame:
    """``parent, text``: the longest text of each parent's children; of equally long ones, that of the
    child with the lowest number."""
    size = F.struct(F.coalesce(F.length(text), F.lit(0)).alias("n"), (-F.col(child)).alias("o"))
    return children.groupBy(parent).agg(F.max_by(text, size).alias(text))


def select_sources(children: DataFrame, fields: tuple[str, ...] = SOURCE_PRIORITY) -> DataFrame:
    """``opinion_id, cluster_id, type, chosen_source, is_ocr_dirty`` of each child; text stays behind."""
    text = chosen_text(fields)
    return children.select("opinion_id", "cluster_id", F.coalesce("type", F.lit("")).alias("type"), chosen_name(fields).alias("chosen_source"), F.coalesce(is_dirty(text), F.lit(False)).alias("is_ocr_dirty"))


def corpus_children(children: DataFrame, resolved: DataFrame, first: int = FIRST_VOLUME, last: int = LAST_VOLUME) -> DataFrame:
    """Children of canonical records in the span."""
    wanted = resolved.where((F.col("dedup_role") == "canonical") & F.col("us_volume").between(first, last)).select("cluster_id")
    return children.join(wanted, "cluster_id", "left_semi")


def read_chosen(children: DataFrame, selected: DataFrame, fields: tuple[str, ...] = SOURCE_PRIORITY) -> DataFrame:
    """``opinion_id, text``: the text of the field that was chosen."""
    both = children.join(selected.select("opinion_id", "chosen_source"), "opinion_id")
    text = F.coalesce(*[F.when(F.col("chosen_source") == f, F.col(f)) for f in fields])
    return both.select("opinion_id", text.alias("text"))
