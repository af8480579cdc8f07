"""Incremental ingest: new record files are folded into a table, the newest reading of each kept.

The table lies in buckets of keys, ``v=<batch>/b=<bucket>``. A batch reads and rewrites the buckets
that its keys fall into, under its own number, and no others; a reader takes each bucket's last
version. Versions that two later ones have replaced are deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lexmill.storage import remove

BUCKETS = 256


def newest(rows: DataFrame, key: str, version: str) -> DataFrame:
    """One row per key: that of the largest version."""
    rest = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*rest), version).alias("r_")).select(key, *[F.col(f"r_.{c}").alias(c) for c in rest])


def numbered(spark: SparkSession, folder: str, letter: str) -> list[int]:
    """Numbers n of the folders ``<letter>=n`` in a folder, in order."""
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []
    return sorted(int(n[2:]) for n in names if n.startswith(f"{letter}="))


def versions(spark: SparkSession, target: str) -> dict[int, list[int]]:
    """The versions of each bucket, in order."""
    found: dict[int, list[int]] = {}
    for v in numbered(spark, target, "v"):
        for b in numbered(spark, f"{target}/v={v}", "b"):
            found.setdefault(b, []).append(v)
    return found


def upsert(batch: DataFrame, batch_id: int, target: str, key: str, version: str, buckets: int = BUCKETS) -> None:
    """Folds a batch into the table. A batch that is run again reads what it read before and writes the
    same rows anew."""
    spark = batch.sparkSession
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    touched = [r.b for r in batch.select(bucket.alias("b")).distinct().collect()]  # at most as many as there are buckets
    known = {b: [v for v in vs if v < batch_id] for b, vs in versions(spark, target).items()}
    before = [f"{target}/v={known[b][-1]}/b={b}" for b in touched if known.get(b)]
    rows = batch.unionByName(spark.read.schema(batch.schema).parquet(*before)) if before else batch
    newest(rows, key, version).withColumn("b", bucket).repartition("b").write.mode("overwrite").partitionBy("b").parquet(f"{target}/v={batch_id}")
    for b in touched:
        for v in known.get(b, [])[:-1]:
            remove(spark, f"{target}/v={v}/b={b}")


def latest(spark: SparkSession, target: str) -> DataFrame:
    """The table after the last batch."""
    return spark.read.parquet(*[f"{target}/v={vs[-1]}/b={b}" for b, vs in versions(spark, target).items()])


def ingest(spark: SparkSession, source: str, schema: T.StructType, target: str, checkpoint: str, key: str, version: str) -> StreamingQuery:
    """Reads the JSON files that are new since the last run, then stops."""
    stream = spark.readStream.schema(schema).option("multiLine", True).json(source)
    writer = stream.writeStream.foreachBatch(lambda df, n: upsert(df, n, target, key, version))
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
