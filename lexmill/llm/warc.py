"""WARC archives with per-record Zstandard frames and a dictionary in a leading skippable frame.

Records with equal payloads of at least ``REVISIT_BYTES`` are stored once: the one with the largest
id is the response, the others are revisits that name it. The winners come from a pre-aggregated
maximum per digest. Rows learn theirs by a broadcast where a payload has more than a thousandth of
all rows, so that such rows are never gathered, and by a shuffle otherwise; records under the bound
are not looked up.

A task trains a dictionary on its first records, writes it as a skippable frame, then compresses
each record as a frame of its own, which a reader that knows the offset can open alone. Files go to
the folder that driver and executors share, under names that no two attempts use; the manifest of
the attempts that succeeded is stored before anything is read, so files of lost or repeated tasks
are never seen by a reader.

Defined results: a null payload is empty; rows equal in payload and id share the record type;
payloads under the bound are responses even when repeated; rows with a null id are written under an
empty id and are never referred to; an empty table writes no file; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.operators.keyed import lookup

from .shared import shared_path, stored

REVISIT_BYTES = 1000
DICTIONARY_BYTES, TRAINING_BYTES, TRAINING_RECORDS = 64_000, 6_000_000, 2000
FILE_BYTES = 256_000_000
#: Fixed value: the magic number of the skippable frame that holds a dictionary.
DICTIONARY_FRAME = 0x184D2A5D
READ_BYTES = 1 << 20


def classify(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """``page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to``; a revisit keeps
    no payload."""
    payload = F.coalesce(F.encode(F.col(payload_col), "UTF-8"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    is_large = F.col("payload_bytes") >= REVISIT_BYTES
    large = rows.where(is_large).withColumn("key", F.sha2("payload", 256))
    repeated = large.groupBy("key").agg(F.max("page_id").alias("winner"), F.count(F.lit(1)).alias("n")).where("n > 1")
    repeated = stored(repeated, "repeated-payloads")
    # small records aren't looked up at all, records of very common payloads without a shuffle
    known = lookup(large, repeated, "key", "n", pages.count(), "left").drop("key")
    every = known.unionByName(rows.where(~is_large).withColumn("winner", F.lit(None).cast("long")))
    revisit = F.col("winner").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("winner"))
    return every.select(
        "page_id", "url", F.when(~revisit, F.col("payload")).alias("payload"), "payload_bytes", F.sha1("payload").alias("payload_digest"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("winner")).alias("refers_to"),
    )


def record(row: dict) -> bytes:
    """A WARC record: named fields, then an HTTP response block (headers alone for a revisit)."""
    payload = row["payload"] or b""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n".encode()
    block = http + payload
    page = "" if row["page_id"] is None else row["page_id"]
    fields = [
        ("WARC-Type", row["record_type"]), ("WARC-Record-ID", f"<urn:page:{page}>"), ("WARC-Target-URI", " ".join((row["url"] or "").split())),
        ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Payload-Digest", f"sha1:{row['payload_digest']}"), ("WARC-Payload-Length", row["payload_bytes"]),
    ]
    if row["record_type"] == "revisit":
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", f"<urn:page:{row['refers_to']}>")]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def train_dictionary(samples: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """A dictionary from records, or none where they are too few or too short to train one."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples)
    except zstandard.ZstdError:
        return None


#: Hadoop's names of stores that Arrow has others for; a mounted store is a local folder to Arrow.
SCHEMES = {"s3a": "s3", "s3n": "s3", "gcs": "gs", "wasb": "abfs", "wasbs": "abfss"}
MOUNTED = {"dbfs": "/dbfs"}


def arrow_path(path: str) -> str:
    """A path as Arrow names it: a URI of a scheme that it knows, or a local path."""
    scheme, found, rest = path.partition(":/")
    if found and scheme in MOUNTED:
        return MOUNTED[scheme] + "/" + rest.lstrip("/")
    return SCHEMES.get(scheme, scheme) + found + rest


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    path = arrow_path(path)
    return fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)


class Writer:
    """One archive: a dictionary frame, if there is a dictionary, and a frame for each record."""

    def __init__(self, path: str, dictionary: zstandard.ZstdCompressionDict | None):
        where, place = filesystem(path)
        where.create_dir(place.rpartition("/")[0], recursive=True)
        self.path, self.records, self.size = path, 0, 0
        self.stream = where.open_output_stream(place)
        self.compressor = zstandard.ZstdCompressor(level=3, dict_data=dictionary, write_content_size=True)
        if dictionary:
            data = dictionary.as_bytes()
            self.put(DICTIONARY_FRAME.to_bytes(4, "little") + len(data).to_bytes(4, "little") + data)

    def put(self, data: bytes) -> None:
        self.stream.write(data)
        self.size += len(data)

    def add(self, item: bytes) -> None:
        self.put(self.compressor.compress(item))
        self.records += 1

    def close(self) -> tuple[str, int, int]:
        self.stream.close()
        return self.path, self.records, self.size


def write_archives(records: DataFrame, folder: str, *, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes the records of ``classify`` and returns the manifest ``path, records, bytes``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0
        dictionary, writer = None, None
        made: list[tuple[str, int, int]] = []

        def add(item: bytes) -> None:
            nonlocal writer
            if writer and writer.size > file_bytes:
                made.append(writer.close())
                writer = None
            writer = writer or Writer(f"{folder}/{uuid.uuid4().hex}.warc.zst", dictionary)
            writer.add(item)

        for batch in batches:
            for i in range(batch.num_rows):
                item = record(batch.slice(i, 1).to_pylist()[0])
                if writer:
                    add(item)
                    continue
                waiting.append(item)
                size += len(item)
                if size >= TRAINING_BYTES or len(waiting) >= TRAINING_RECORDS:
                    dictionary = train_dictionary(waiting)
                    for x in waiting:
                        add(x)
                    waiting = []
        if waiting:
            dictionary = train_dictionary(waiting)
            for x in waiting:
                add(x)
        if writer:
            made.append(writer.close())
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*made, strict=True)], ["path", "records", "bytes"])

    return stored(records.mapInArrow(run, "path string, records long, bytes long"), "manifest")


def frames(stream) -> Iterator[bytes]:
    """Records of an archive, one for each frame, with bounded reads."""
    held = stream.read(8)
    dictionary = None
    if len(held) == 8 and int.from_bytes(held[:4], "little") == DICTIONARY_FRAME:
        dictionary = zstandard.ZstdCompressionDict(stream.read(int.from_bytes(held[4:], "little")))
        held = b""
    reader = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
    while True:
        frame, out = reader.decompressobj(), []
        while not frame.eof:
            held = held or stream.read(READ_BYTES)
            if not held:
                if out:
                    raise ValueError("an archive ends inside a record")
                return
            out.append(frame.decompress(held))
            held = frame.unused_data if frame.eof else b""
        yield b"".join(out)


def parse(item: bytes) -> dict:
    """Named fields and payload of a record."""
    head, _, block = item.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    block = block[: int(fields["Content-Length"])]
    return fields | {"payload": block.partition(b"\r\n\r\n")[2]}


def read_archives(manifest: DataFrame) -> DataFrame:
    """One row for each record of the archives; digests of stored payloads are computed anew."""
    spark = manifest.sparkSession
    files = manifest.count()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = lambda s: int(n) if (n := s[len("<urn:page:") : -1]) else None
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        for batch in batches:
            for path in batch.column(0).to_pylist():
                where, place = filesystem(path)
                rows: list[tuple] = []
                with where.open_input_stream(place) as stream:
                    for item in frames(stream):
                        r = parse(item)
                        digest, size = r["WARC-Payload-Digest"].removeprefix("sha1:"), int(r["WARC-Payload-Length"])
                        if r["WARC-Type"] == "response" and (digest, size) != (hashlib.sha1(r["payload"]).hexdigest(), len(r["payload"])):
                            raise ValueError(f"{r['WARC-Record-ID']} in {path} differs from its digest")
                        rows.append((number(r["WARC-Record-ID"]), size, digest, r["WARC-Type"], number(r["WARC-Refers-To"]) if "WARC-Refers-To" in r else None))
                for i in range(0, len(rows), 10_000):
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows[i : i + 10_000], strict=True), kinds, strict=True)], names)

    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    if not files:
        return spark.createDataFrame([], schema)
    return manifest.select("path").repartition(files).mapInArrow(run, schema)


def archive(spark: SparkSession, pages: DataFrame, **columns: str) -> DataFrame:
    """Writes archives of ``pages`` into the shared folder and returns their manifest."""
    return write_archives(classify(pages, **columns), shared_path(spark, "warc"))


def dictionary_of(path: str) -> bytes | None:
    """The dictionary that an archive carries."""
    where, place = filesystem(path)
    with where.open_input_stream(place) as stream:
        head = stream.read(8)
        if int.from_bytes(head[:4], "little") != DICTIONARY_FRAME:
            return None
        return stream.read(int.from_bytes(head[4:], "little"))
