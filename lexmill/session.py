"""Session factory and table access."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def build_session(app: str = "lexmill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the engine relies on: UTC, ANSI and adaptive execution.

    On a cluster, ``master`` and memory come from spark-submit; pass ``master`` for local work. The
    package is shipped to a cluster's executors; a session made otherwise needs ``ship``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
    } | conf
    spark = builder.config(map=settings).getOrCreate()
    if not spark.sparkContext.master.startswith("local"):
        ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, which need it for Arrow functions."""
    with tempfile.TemporaryDirectory() as folder:
        package = os.path.dirname(os.path.abspath(__file__))
        made = shutil.make_archive(os.path.join(folder, "lexmill"), "zip", os.path.dirname(package), os.path.basename(package))
        spark.sparkContext.addPyFile(made)


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """One of the corpus tables, through Spark's own reader so that any store works."""
    return spark.read.parquet(f"{directory}/{name}.parquet")
