"""Archives: exact round trips, revisits against brute force, dictionaries."""

import hashlib
import random

import duckdb
import pytest
import zstandard

from lexmill.llm import warc
from lexmill.llm.queries import op8_warc, oracle_sql


def expected(rows):
    out = []
    for page, _, html in rows:
        payload = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == payload and p is not None]
        top = max(same) if same and len(payload) >= 1000 else page
        out.append((page, len(payload), hashlib.sha1(payload).hexdigest(), "response" if top == page else "revisit", None if top == page else top))
    return sorted(out, key=str)


def test_round_trip_of_odd_rows(spark):
    rnd = random.Random(1)
    rows = [(1, "u\r\nv", None), (2, None, ""), (3, "u", "é𝒳\r\n\r\n" * 3), (None, "n", "z" * 2000), (5, "a", "z" * 2000), (5, "b", "z" * 2000), (6, "x", "y" * 3_000_000)]
    rows += [(10 + i, f"u{i}", "<p>" + rnd.choice("abcd") * rnd.choice([900, 997, 1500]) + "</p>") for i in range(300)]
    df = spark.createDataFrame([(*r, "c") for r in rows], "page_id long, url string, html string, payload string")
    manifest = warc.archive(spark, df)
    got = sorted((tuple(r) for r in warc.read_archives(manifest).collect()), key=str)
    assert got == expected(rows)
    assert warc.read_archives(warc.archive(spark, df.limit(0))).collect() == []


def test_dictionary_leads_and_records_stand_alone(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    found = warc.archive(spark, pages.coalesce(1)).collect()
    assert sum(r.records for r in found) == pages.count()
    path = found[0].path
    dictionary = warc.dictionary_of(path)
    where, place = warc.filesystem(path)
    data = where.open_input_stream(place).read()
    assert dictionary and data[8 : 8 + len(dictionary)] == dictionary
    one = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary)).decompressobj()
    assert one.decompress(data[8 + len(dictionary) :]).startswith(b"WARC/1.1\r\n") and one.unused_data


def test_files_roll_over(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    manifest = warc.write_archives(warc.classify(pages), warc.shared_path(spark, "rolled"), file_bytes=100_000)
    assert manifest.count() > 3 and warc.read_archives(manifest).count() == pages.count()


def test_query_matches_sql(spark):
    db = duckdb.connect()
    db.sql("CREATE VIEW pages AS SELECT * FROM '/root/testdata/sf0.01/pages.parquet'")
    want = sorted(db.sql(oracle_sql()["op8_warc"]).project("page_id, payload_bytes, payload_digest, record_type, refers_to").fetchall(), key=str)
    assert sorted((tuple(r) for r in op8_warc(spark, "/root/testdata/sf0.01").collect()), key=str) == want


@pytest.mark.parametrize("path, want", [
    ("s3a://bucket/a b/c", "s3://bucket/a b/c"), ("s3n://b/c", "s3://b/c"), ("gs://b/c", "gs://b/c"), ("hdfs://host:8020/x", "hdfs://host:8020/x"), ("file:///x/y", "file:///x/y"), ("file:/x/y", "file:/x/y"),
    ("abfss://c@a.dfs.core.windows.net/x", "abfss://c@a.dfs.core.windows.net/x"), ("wasbs://c@a/x", "abfss://c@a/x"), ("dbfs:/tmp/x", "/dbfs/tmp/x"), ("/x/s3a", "/x/s3a"),
])
def test_paths_of_object_stores(path, want):
    assert warc.arrow_path(path) == want
