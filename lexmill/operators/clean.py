"""Markup to text that offsets address, with page breaks and suspect spots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.functions.arrow import CLEAN_VERSION
from lexmill.functions.markup import rendered as rendered_markup
from lexmill.functions.text import suspects, suspects_json


def clean(texts: DataFrame, key: str = "opinion_id", text: str = "text") -> DataFrame:
    """``key, clean_text, page_breaks, suspects, ocr_suspect, clean_version`` of each row.

    Plain markup is rendered natively, other markup in Arrow batches; spots are then found in the text that results.
    """
    rendered = texts.select(key, rendered_markup(F.col(text)).alias("r")).select(key, "r.clean_text", "r.page_breaks")
    found = rendered.withColumn("suspects", suspects("clean_text"))
    return found.select("*", suspects_json("suspects").alias("ocr_suspect"), F.lit(CLEAN_VERSION).alias("clean_version"))


def page_breaks(cleaned: DataFrame, key: str = "opinion_id") -> DataFrame:
    return cleaned.select(key, F.explode("page_breaks").alias("b")).select(key, "b.ordinal", "b.page_label", "b.char_offset", "b.anchor")


def suspect_rows(cleaned: DataFrame, key: str = "opinion_id") -> DataFrame:
    """A row per spot, numbered from 1, from the stored JSON."""
    hits = F.from_json("ocr_suspect", "struct<count:int,hits:array<struct<offset:long,token:string>>>")["hits"]
    rows = cleaned.where(F.col("ocr_suspect").isNotNull()).select(key, F.posexplode(hits))
    return rows.select(key, (F.col("pos") + 1).alias("ordinal"), F.col("col.offset").alias("char_offset"), F.col("col.token").alias("token"))


def page_of(texts: DataFrame, breaks: DataFrame, phrase: str, key: str = "opinion_id", text: str = "clean_text") -> DataFrame:
    """The page label on which ``phrase`` begins: the largest, as text, of the breaks up to it."""
    place = texts.select(key, F.instr(F.col(text), phrase).alias("place"))
    return breaks.join(place, key).where("char_offset <= place").groupBy(key).agg(F.max("page_label").alias("page_label"))
