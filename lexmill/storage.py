"""Tables written to the folder that driver and executors share."""

from __future__ import annotations

import functools
import gc
import tempfile
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder, as ``spark.checkpoint.dir`` names it.

    Where the setting is missing, a local session gets a temporary folder; a cluster session is
    refused, because its executors could not see such a folder.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    made = "file://" + tempfile.mkdtemp(prefix="lexmill-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder; inside a ``scratched`` function it is removed in the end."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    if scopes():
        scopes()[-1].append(path)
    return path


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and reread: lineage ends there, and a lost executor
    costs a reread instead of a recomputation."""
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Asks the driver's JVM to collect its garbage. Spark removes the shuffle files of a finished job only after that,
    by itself every half hour, so that the files of all steps so far would stay on the executors' disks."""
    gc.collect()
    spark._jvm.System.gc()


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a file or folder, if it is there."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


_local = threading.local()


def scopes() -> list[list[str]]:
    """Paths made inside each ``scratched`` function that runs in this thread, the outermost first."""
    if not hasattr(_local, "scopes"):
        _local.scopes = []
    return _local.scopes


def scratched(label: str) -> Callable[[Callable[..., DataFrame]], Callable[..., DataFrame]]:
    """Stores the DataFrame that a function returns, and then removes all else that it stored."""

    def decorate(build: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        @functools.wraps(build)
        def run(*args, **kwargs) -> DataFrame:
            made: list[str] = []
            scopes().append(made)
            try:
                result = build(*args, **kwargs)
            finally:
                scopes().pop()
            kept = stored(result, label)
            for path in made:
                remove(kept.sparkSession, path)
            return kept

        return run

    return decorate
