"""Every query with SQL gives the same rows in Spark and in DuckDB."""

import datetime
import math
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(__file__)))

from lexmill import registry
from lexmill.session import TABLES

DIR = os.environ.get("PARITY_DIR", "/root/testdata/sf0.001")


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


KINDS = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP"}


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{DIR}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_same_rows(spark, db, name):
    mine = registry.queries()[name](spark, DIR)
    theirs = db.sql(registry.oracle_sql()[name])
    columns = sorted(mine.columns)
    assert columns == sorted(theirs.columns)
    kinds = dict(zip(theirs.columns, map(str, theirs.types)))
    assert {c: KINDS[k] for c, k in mine.dtypes} == {c: k.removesuffix("_NS").removesuffix("_US").removesuffix(" WITH TIME ZONE") for c, k in kinds.items()}
    a = sorted(tuple(plain(r[c]) for c in columns) for r in mine.collect())
    b = sorted(tuple(map(plain, r)) for r in theirs.project(", ".join(f'"{c}"' for c in columns)).fetchall())
    assert a == b


def test_every_query_has_sql():
    assert set(registry.queries()) == set(registry.oracle_sql())


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0 and set(entry.oracle_sql()) <= set(entry.queries())
