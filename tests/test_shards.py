"""Tar shards written and read by tasks."""

import hashlib
import tarfile

import pytest

from lexmill.sources import shards

FILES = [(f"clusters/{i}.json", f"{{{i}é}}".encode() * (i % 60)) for i in range(200)] + [("a/" + "long" * 60 + "é.json", b"x"), ("empty", b""), ("null", None)]


def table(spark, rows, parts):
    return spark.createDataFrame(rows, "path string, content binary").repartition(parts)


def read(folder):
    return {p.name: hashlib.sha256(p.read_bytes()).hexdigest() for p in (folder / "shards").glob("*.tar.gz")}


def test_same_bytes_however_dealt(spark, tmp_path):
    sums = [shards.pack(table(spark, rows, parts), f"{tmp_path}/{k}", shard_bytes=3000) for k, (rows, parts) in enumerate(((FILES, 1), (FILES[::-1], 7)))]
    one, other = read(tmp_path / "0"), read(tmp_path / "1")
    assert sums[0] == sums[1] and one == other and len(one) > 3
    got = {r.path: bytes(r.content) for r in shards.unpack(spark, f"file://{tmp_path}/0").collect()}
    assert got == {p: c or b"" for p, c in FILES}
    assert shards.verify(spark, f"{tmp_path}/0").collect() == []
    with tarfile.open(next((tmp_path / "0/shards").glob("*.tar.gz"))) as plain:
        names = plain.getnames()
    assert names == sorted(names)
    more = shards.pack(table(spark, [*FILES[:-1], ("null", b"!")], 2), f"{tmp_path}/2", shard_bytes=3000)
    assert more != sums[0]


def test_what_was_changed_shows(spark, tmp_path):
    shards.pack(table(spark, FILES, 2), f"{tmp_path}/x")
    shards.pack(table(spark, [(p, b"other" if p == "empty" else c) for p, c in FILES if p != "clusters/7.json"], 2), f"{tmp_path}/y")
    for p in (tmp_path / "y/shards").glob("*.tar.gz"):
        (tmp_path / "x/shards" / p.name).write_bytes(p.read_bytes())
    for p in (tmp_path / "x/shards").glob(".*.crc"):
        p.unlink()
    assert sorted(map(tuple, shards.verify(spark, f"{tmp_path}/x").collect())) == [("clusters/7.json", "missing"), ("empty", "hash mismatch")]


@pytest.mark.parametrize("rows", [[("/etc/x", b"")], [("a/../../x", b"")], [("twice", b"1"), ("twice", b"2")]])
def test_bad_paths_are_refused(spark, tmp_path, rows):
    with pytest.raises(Exception, match="twice or leaves its folder"):
        shards.pack(table(spark, rows, 1), f"{tmp_path}/bad")


def test_members_outside_the_folder_are_refused(spark, tmp_path):
    (tmp_path / "shards").mkdir()
    with tarfile.open(tmp_path / "shards/000000.tar.gz", "w:gz") as archive:
        archive.addfile(tarfile.TarInfo("../evil"))
    with pytest.raises(Exception, match="no file below its folder"):
        shards.unpack(spark, str(tmp_path)).collect()


def test_no_files(spark, tmp_path):
    assert shards.pack(table(spark, [], 1), f"{tmp_path}/none") == hashlib.sha256().hexdigest()
