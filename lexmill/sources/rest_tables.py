"""A paged REST API as tables: listings by year as a Spark data source, children by parent as a job.

Each year of a listing is a partition, read by one task page by page, which raises if ids repeat or the
number of records isn't the one declared; Spark then runs the task again. ``streams`` is how many
tasks may ask at the same time: each waits that many times longer between requests, so that the
server sees the pace of one. ``mirror`` writes years in groups of ``streams``; a year is there once its
folder is complete, and a run that was killed goes on with the years that aren't.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from lexmill.operators.versions import files
from lexmill.sources import rest

FORMAT = "lexmill_rest"
RECORD = "id long, year int, page int, record string"
HEADER = "header."


class Year(InputPartition):
    def __init__(self, span: tuple[str, str]):
        self.span = span


def paced(options: dict) -> rest.Client:
    """A client whose waits leave room for the other streams."""
    streams = int(options.get("streams", 1))
    found = {k[len(HEADER) :]: v for k, v in options.items() if k.lower().startswith(HEADER)}
    client = rest.Client(headers=found)
    one = client.sleep
    client.sleep = lambda seconds: one(seconds * streams * float(options.get("patience", 1)))
    return client


class Listing(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self) -> list[Year]:
        asked = {int(y) for y in self.options.get("years", "").split(",") if y}
        every = rest.spans(self.options["after"], self.options["before"])
        return [Year(s) for s in every if not asked or int(s[0][:4]) in asked] or [Year(("", ""))]

    def read(self, partition: Year) -> Iterator[tuple]:
        if not partition.span[0]:
            return
        client, ids, declared, year = paced(self.options), Counter(), None, int(partition.span[0][:4])
        query = json.loads(self.options.get("query", "{}"))
        for number, page in enumerate(client.pages(rest.span_url(self.options["url"], partition.span, query))):
            declared = client.declared_count(page) if not number else declared
            for record in page.get("results", ()):
                rest.check(record, self.options.get("entity", "cluster"))
                ids[record["id"]] += 1
                if ids[record["id"]] > 1:
                    raise rest.ListingError(f"{year}: record {record['id']} came twice")
                yield record["id"], year, number, json.dumps(record, sort_keys=True, ensure_ascii=False)
        if declared not in (None, len(ids)):
            raise rest.ListingError(f"{year}: {len(ids)} records came, {declared} declared")


class RestListing(DataSource):
    """``spark.read.format("lexmill_rest")`` with options ``url, after, before`` and, if wanted, ``years``, ``entity``,
    ``query`` (JSON), ``streams`` and ``header.<name>``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return RECORD

    def reader(self, schema: StructType) -> Listing:
        return Listing(dict(self.options))


def listing(spark: SparkSession, url: str, after: str, before: str, **options: object) -> DataFrame:
    """Records of a listing between two dates: ``id, year, page, record``, the record as JSON."""
    spark.dataSource.register(RestListing)
    reader = spark.read.format(FORMAT).option("url", url).option("after", after).option("before", before)
    return reader.options(**{k: str(v) for k, v in options.items()}).load()


def complete(spark: SparkSession, folder: str) -> bool:
    where, fs = files(spark, f"{folder}/_SUCCESS")
    return fs.exists(where)


def mirror(spark: SparkSession, url: str, after: str, before: str, target: str, *, streams: int = 4, **options: object) -> list[int]:
    """Writes the years of a listing that ``target`` lacks, and returns them."""
    years = [int(a[:4]) for a, _ in rest.spans(after, before)]
    absent = [y for y in years if not complete(spark, f"{target}/year={y}")]
    for i in range(0, len(absent), streams):
        group = absent[i : i + streams]
        rows = listing(spark, url, after, before, years=",".join(map(str, group)), streams=len(group), **options)
        rows.write.mode("overwrite").partitionBy("year").parquet(f"{target}/_group")
        for year in group:  # a year without records has a folder, too
            found, fs = files(spark, f"{target}/_group/year={year}")
            place, _ = files(spark, f"{target}/year={year}")
            fs.delete(place, True)
            fs.rename(found, place) if fs.exists(found) else fs.mkdirs(place)
            fs.create(files(spark, f"{target}/year={year}/_SUCCESS")[0], True).close()
    where, fs = files(spark, f"{target}/_group")
    fs.delete(where, True)
    return absent


def mirrored(spark: SparkSession, target: str) -> DataFrame:
    """All records of a mirror."""
    return spark.read.schema(RECORD).option("basePath", target).parquet(f"{target}/year=*")


def children(parents: DataFrame, url: str, known: DataFrame | None = None, *, streams: int = 4, **options: object) -> DataFrame:
    """``id, cluster_id, record`` of the children of ``parents(cluster_id, wanted)``, asked parent by parent.

    Parents all of whose declared children are in ``known(id)`` aren't asked; one that declares none is asked
    each time. A declared child that doesn't come, or a list of several pages, raises.
    """
    if known is not None:
        lacking = parents.select("cluster_id", F.explode_outer("wanted").alias("id")).join(known.select("id"), "id", "left_anti")
        parents = parents.join(lacking.select("cluster_id").distinct(), "cluster_id", "left_semi")
    settings = {k: str(v) for k, v in options.items()} | {"streams": str(streams)}

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client = paced(settings)
        for batch in batches:
            for parent, wanted in zip(batch["cluster_id"].to_pylist(), batch["wanted"].to_pylist()):
                page = client.get(rest.with_query(url, cluster=parent), timeout=90, paced=True)
                if page.get("next"):
                    raise rest.ListingError(f"the children of {parent} fill several pages")
                found = [rest.check(r, "opinion") for r in rest.results([page])]
                ids = [r["id"] for r in found]
                if absent := set(wanted or ()) - set(ids):
                    raise rest.ListingError(f"children of {parent} are absent: {sorted(absent)}")
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([parent] * len(ids), pa.int64()), pa.array([json.dumps(r, sort_keys=True, ensure_ascii=False) for r in found], pa.string())], names=["id", "cluster_id", "record"])
                client.sleep(client.pace)

    return parents.select("cluster_id", "wanted").repartition(streams).mapInArrow(fetch, "id long, cluster_id long, record string")
