"""Archives of many files as tar shards that tasks write and read, with a tree of checksums.

A file's shard follows from its path, and how many there are from the bytes of all; members of a shard
are in order of their paths, with fixed headers, and compression has no timestamp. So the bytes of
every shard are the same however the rows were dealt out, and a task that runs again writes them anew.
The ledger has the checksum of each file; a shard's is of its files' lines, and the root's of the shards'.
"""

from __future__ import annotations

import hashlib
import io
import math
import tarfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.operators import snapshots

#: Bytes of files in a shard, about: a reader's task holds one.
SHARD_BYTES = 64_000_000
LEDGER = "shard long, path string, sha256 string, size long"


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """A file system as Arrow knows it, and the place in it."""
    uri = path.replace("s3a://", "s3://", 1) if path.startswith("s3a://") else path
    return fs.FileSystem.from_uri(uri) if ":/" in uri else (fs.LocalFileSystem(), uri)


def header(path: str, size: int) -> bytes:
    """A member's header, with nothing in it but its name and size."""
    info = tarfile.TarInfo(path)
    info.size, info.mtime, info.mode = size, 0, 0o644
    return info.tobuf(tarfile.PAX_FORMAT)


def safe(path: str) -> bool:
    """Whether a name stays below the folder that it is unpacked to."""
    return bool(path) and not path.startswith("/") and ".." not in path.split("/") and "\\" not in path


class Shard:
    """One archive that is being written."""

    def __init__(self, folder: str, number: int):
        where, place = opened(folder)
        where.create_dir(place, recursive=True)
        self.stream = where.open_output_stream(f"{place}/{number:06d}.tar.gz", compression=None)
        self.packer = zlib.compressobj(6, zlib.DEFLATED, 31)

    def add(self, path: str, content: bytes) -> None:
        for piece in (header(path, len(content)), content, b"\0" * (-len(content) % tarfile.BLOCKSIZE)):
            self.stream.write(self.packer.compress(piece))

    def close(self) -> None:
        self.stream.write(self.packer.compress(b"\0" * 2 * tarfile.BLOCKSIZE) + self.packer.flush())
        self.stream.close()


def shard_of(path: str, shards: int) -> Column:
    return F.pmod(F.xxhash64(path), F.lit(shards))


def pack(files: DataFrame, target: str, *, shard_bytes: int = SHARD_BYTES) -> str:
    """Writes ``files(path, content)`` as shards with their ledger under ``target``; returns the root's checksum.

    A path is there once; a null content is an empty file, and paths that leave the folder raise.
    """
    files = files.select("path", F.coalesce("content", F.lit(b"")).alias("content"))
    total = files.agg(F.sum(F.length("content"))).first()[0] or 0
    shards = max(1, math.ceil(total / shard_bytes))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, shard, last = None, None, None
        for batch in batches:
            rows = []
            for n, path, content in zip(*(batch[c].to_pylist() for c in ("shard", "path", "content"))):
                if not safe(path) or (n, path) == (number, last):
                    raise ValueError(f"the path {path!r} comes twice or leaves its folder")
                if n != number:
                    if shard:
                        shard.close()
                    number, shard = n, Shard(f"{target}/shards", n)
                shard.add(path, content)
                last = path
                rows.append((n, path, hashlib.sha256(content).hexdigest(), len(content)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["shard", "path", "sha256", "size"])
        if shard:
            shard.close()

    dealt = files.withColumn("shard", shard_of("path", shards)).repartition("shard").sortWithinPartitions("shard", "path")
    dealt.mapInArrow(write, LEDGER).write.mode("overwrite").parquet(f"{target}/ledger")
    return root(files.sparkSession, target)


def ledger(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.schema(LEDGER).parquet(f"{target}/ledger")


def shard_sums(lines: DataFrame) -> DataFrame:
    """``shard, sha256``: of a shard's lines in order; a shard has as many as fit into its bytes."""
    line = F.struct("path", F.concat("sha256", F.lit("  "), "path", F.lit("\n")).alias("line"))
    return lines.groupBy("shard").agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(line)), lambda x: x["line"]), ""), 256).alias("sha256"))


def root(spark: SparkSession, target: str) -> str:
    """The checksum over all shards' checksums, in order."""
    digest = hashlib.sha256()
    for r in shard_sums(ledger(spark, target)).orderBy("shard").toLocalIterator():
        digest.update(f"{r.sha256}  {r.shard:06d}\n".encode())
    return digest.hexdigest()


def unpack(spark: SparkSession, target: str) -> DataFrame:
    """``path, content`` of all files in the shards."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch["content"]:
                with tarfile.open(fileobj=io.BytesIO(content.as_py()), mode="r:gz") as archive:
                    for member in archive:
                        if not member.isfile() or not safe(member.name):
                            raise ValueError(f"the archive has a member {member.name!r} that is no file below its folder")
                        yield pa.RecordBatch.from_arrays([pa.array([member.name]), pa.array([archive.extractfile(member).read()], pa.binary())], names=["path", "content"])

    shards = spark.read.format("binaryFile").option("pathGlobFilter", "*.tar.gz").load(f"{target}/shards").select("content")
    return shards.mapInArrow(read, "path string, content binary")


def verify(spark: SparkSession, target: str) -> DataFrame:
    """``path, reason`` where shards and ledger disagree; empty if all is well."""
    return snapshots.verify(snapshots.checksums(unpack(spark, target)), ledger(spark, target))
