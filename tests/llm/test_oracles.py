"""Queries with SQL give the same rows in Spark and in DuckDB."""

import duckdb
import pytest

from lexmill.llm import queries

DIR = "/root/testdata/sf0.01"
KINDS = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_same_rows(spark, name):
    db = duckdb.connect()
    for table in ("documents", "pages", "conversations", "embeddings"):
        db.sql(f"CREATE VIEW {table} AS SELECT * FROM '{DIR}/{table}.parquet'")
    mine, theirs = queries.queries()[name](spark, DIR), db.sql(queries.oracle_sql()[name])
    columns = sorted(mine.columns)
    assert {c: KINDS[k] for c, k in mine.dtypes} == dict(zip(theirs.columns, map(str, theirs.types)))
    a = sorted((tuple(r[c] for c in columns) for r in mine.collect()), key=str)
    assert a == sorted(theirs.project(", ".join(columns)).fetchall(), key=str)
