"""Ordered rules with evidence, and verdicts that a person has overruled."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.functions.text import leading_int

# Volumes in scope, the first of a single court, and that court's first page in volume 2.
FIRST_VOLUME, LAST_VOLUME, SINGLE_COURT_VOLUME, FIRST_PAGE = 2, 19, 5, 401
VERDICT = T.StructType([T.StructField("verdict", T.StringType()), T.StructField("evidence", T.StringType())])


def first_rule(rules: Sequence[tuple[Column, Column | str, Column | str]], otherwise: tuple[Column | str, Column | str]) -> Column:
    """A struct of verdict and evidence: those of the first rule whose condition is true."""
    lit = lambda x: F.lit(x) if isinstance(x, str) else x
    pair = lambda v, e: F.struct(lit(v).alias("verdict"), lit(e).alias("evidence"))
    chain = None
    for condition, verdict, evidence in rules:
        chain = F.when(condition, pair(verdict, evidence)) if chain is None else chain.when(condition, pair(verdict, evidence))
    last = pair(*otherwise)
    return last if chain is None else chain.otherwise(last)


def tells(named: Sequence[tuple[Column, str]]) -> Column:
    """Names of the conditions that hold, in order, joined by semicolons."""
    return F.concat_ws(";", *[F.when(c, F.lit(n)) for c, n in named])


def other_court_tells(name: str = "case_name", volume: str = "us_volume", page: str = "us_page") -> Column:
    """Signs that a record is another court's: parties of state courts, early pages of volume 2."""
    lower = F.lower(F.coalesce(name, F.lit("")))
    return tells([
        (lower.startswith("respublica") | lower.contains("commonwealth"), "respublica/commonwealth"),
        (lower.startswith("united states v"), "us_criminal_caption"),
        (lower.contains("lessee"), "lessee_ejectment"),
        ((F.col(volume) == 2) & (leading_int(page) < FIRST_PAGE), "page_before_scotus_start"),
    ])


def with_ledger(rows: DataFrame, ledger: DataFrame, key: str) -> DataFrame:
    """Adds ``disposition`` of a ledger, null where it has none; one row per key is kept."""
    last = ledger.groupBy(key).agg(F.max_by("disposition", "row").alias("disposition")) if "row" in ledger.columns else ledger.select(key, "disposition")
    return rows.join(last, key, "left")


def scope(records: DataFrame, ledger: DataFrame, sign: Column | None = None) -> DataFrame:
    """``is_scotus`` ('true' or 'false') and ``evidence`` of each record.

    In order: the ledger; no citation; a volume out of scope; volumes of the single court; a known
    identifier; else not in scope, with the signs that say so.
    """
    sign = other_court_tells() if sign is None else sign
    volume = F.col("us_volume")
    known = F.coalesce(F.col("scdb_id") != "", F.lit(False))
    chain = first_rule(
        [
            (F.col("disposition") == "keep", "true", "human_review"),
            (F.col("disposition") == "drop", "false", "human_review"),
            (F.col("us_cite").isNull(), "false", "no_us_reports_cite"),
            (volume.isNull() | ~volume.between(FIRST_VOLUME, LAST_VOLUME), "false", "out_of_scope_volume"),
            ((volume >= SINGLE_COURT_VOLUME) & known, "true", "scotus_reporter+scdb"),
            (volume >= SINGLE_COURT_VOLUME, "true", "scotus_only_reporter"),
            (known, "true", "scdb_id"),
        ],
        ("false", F.when(sign == "", F.lit("dallas_not_in_scdb")).otherwise(F.concat(F.lit("dallas_not_in_scdb:"), sign))),
    )
    judged = with_ledger(records, ledger, "cluster_id").withColumn("v_", chain)
    proposal = F.when(F.col("v_.verdict") == "true", "keep").otherwise("drop")
    return judged.select(*records.columns, F.col("v_.verdict").alias("is_scotus"), F.col("v_.evidence").alias("evidence"), proposal.alias("proposed"))
