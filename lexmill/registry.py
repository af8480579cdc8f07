"""All registered queries with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lexmill.queries import matching, relational, staged, texts

PARTS = (relational.query, texts.query, matching.query, staged.query)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for part in PARTS for k, f in part.queries.items()}


def oracle_sql() -> dict[str, str]:
    return {k: q for part in PARTS for k, q in part.sql.items()}
