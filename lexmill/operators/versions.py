"""Sets of tables that are published as a whole or not at all.

A set is written to a folder of its own, ``v=<n>``. Then a manifest with each table's rows and a hash of them is
written beside it and renamed into place, which is the commit: a reader takes the tables of the last manifest,
so that a run that is killed at any point leaves the set before it readable. The next run removes what was
never committed, and versions beyond those that are kept.

Rows and hashes, and whatever else is asked of a table, are observed in the job that writes it.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lexmill.storage import remove

MANIFESTS = "_manifests"


def files(spark: SparkSession, path: str):
    """A path and its file system."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def numbers(spark: SparkSession, folder: str, before: str, after: str = "") -> list[int]:
    """The n of names ``<before>n<after>`` in a folder, in order."""
    where, fs = files(spark, folder)
    names = [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []
    inner = [n[len(before) : len(n) - len(after)] for n in names if n.startswith(before) and n.endswith(after)]
    return sorted(int(n) for n in inner if n.isdigit())


def current(spark: SparkSession, target: str) -> dict | None:
    """The manifest of the last committed version."""
    known = numbers(spark, f"{target}/{MANIFESTS}", "", ".json")
    if not known:
        return None
    return json.loads("\n".join(r.value for r in spark.read.text(f"{target}/{MANIFESTS}/{known[-1]}.json").collect()))


def table(spark: SparkSession, target: str, name: str) -> DataFrame:
    """A table of the last committed version."""
    found = current(spark, target)
    if found is None or name not in found["tables"]:
        raise FileNotFoundError(f"{target} has no committed table {name}")
    return spark.read.parquet(f"{target}/v={found['version']}/{name}")


class Draft:
    """A version that is being written."""

    def __init__(self, spark: SparkSession, target: str):
        self.spark, self.target, self.tables = spark, target, {}
        known = numbers(spark, f"{target}/{MANIFESTS}", "", ".json")
        written = numbers(spark, target, "v=")
        for n in set(written) - set(known):  # never committed
            remove(spark, f"{target}/v={n}")
        self.version = max([0, *known, *written]) + 1

    def path(self, name: str) -> str:
        return f"{self.target}/v={self.version}/{name}"

    def write(self, name: str, df: DataFrame, *partition_by: str, **asked: Column) -> dict[str, int]:
        """Writes a table, and returns what is ``asked`` (aggregates by name) of its rows."""
        seen = Observation()
        hashed = F.sum(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("decimal(38,0)"))
        watched = df.observe(seen, F.count(F.lit(1)).alias("rows_"), hashed.alias("hash_"), *[c.alias(k) for k, c in asked.items()])
        watched.write.partitionBy(*partition_by).parquet(self.path(name))
        got = dict(seen.get)
        self.tables[name] = {"rows": got.pop("rows_"), "hash": str(got.pop("hash_") or 0)}
        return got

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def commit(self, keep: int = 2) -> None:
        """Makes this version the one that readers see, and removes all but the last ``keep``."""
        where, fs = files(self.spark, f"{self.target}/{MANIFESTS}/{self.version}.json")
        waiting = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.target}/{MANIFESTS}/.{self.version}.waiting")
        out = fs.create(waiting, True)
        out.write(bytearray(json.dumps({"version": self.version, "tables": self.tables}, sort_keys=True).encode()))
        out.close()
        if not fs.rename(waiting, where):
            raise FileExistsError(f"{where} is already there: another run has published version {self.version}")
        for n in numbers(self.spark, f"{self.target}/{MANIFESTS}", "", ".json")[:-keep]:
            remove(self.spark, f"{self.target}/{MANIFESTS}/{n}.json")
            remove(self.spark, f"{self.target}/v={n}")
