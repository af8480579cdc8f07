"""Sources, archives, the REST client, streaming ingest, and all stages from files to tables."""

import hashlib
import io
import json
import tarfile
import urllib.error

import pytest
from pyspark.sql import functions as F

from lexmill import config
from lexmill.plans import checks, stages
from lexmill.sources import archive, records, rest
from lexmill.streaming import ingest


class Server:
    """Answers by URL part, one after another; numbers are HTTP errors."""

    def __init__(self, **answers):
        self.answers = {k: list(v) for k, v in answers.items()}
        self.slept = []

    def open(self, request, timeout=0):
        key = next(k for k in self.answers if k in request.full_url)
        found = self.answers[key].pop(0)
        if isinstance(found, tuple):
            raise urllib.error.HTTPError(request.full_url, found[0], "", found[1], None)
        if isinstance(found, Exception):
            raise found
        return io.BytesIO(json.dumps(found).encode())

    def client(self):
        return rest.Client(sleep=self.slept.append, opener=self.open)


def parent(i, *declared):
    return {"id": i, "case_name": "n", "date_filed": "1801-01-01", "citations": [], "source": "U", "sub_opinions": [f"/o/{c}/" for c in declared]}


def test_retries():
    server = Server(x=[(429, {"Retry-After": "3"}), (503, {}), urllib.error.URLError("down"), {"ok": 1}])
    client = server.client()
    assert client.get("http://h/x", paced=True) == {"ok": 1}
    assert server.slept == [4, 10, 15] and client.pace == 1.5
    assert client.log == {"attempts": 4, "retry_after": 1, "server_errors": 1, "network_errors": 1}
    assert client.trace == [{"url": "http://h/x", "attempts": 4, "codes": [429, 503, None], "waits": [4, 10, 15]}]
    with pytest.raises(urllib.error.HTTPError):
        Server(x=[(404, {})]).client().get("http://h/x")
    with pytest.raises(RuntimeError, match="no answer"):
        Server(x=[(500, {})] * 6).client().get("http://h/x")


def test_mirror_and_resume(tmp_path):
    server = Server(
        parents=[{"count": "http://h/count", "results": [parent(1, 10)], "next": "http://h/parents2"}, {"results": [parent(2)], "next": None}],
        count=[{"count": 2}], children=[{"results": [{"id": 10, "cluster": "/c/1/", "type": "t"}]}, {"results": []}, {"results": []}],
    )
    server.answers["children"].append({"results": []})
    args = ("http://h/parents", "http://h/children", "1801-05-01", "1801-09-30", tmp_path)
    manifest = rest.extract(server.client(), *args)
    assert (manifest["n_clusters"], manifest["n_opinions"], manifest["opinions_fetched_this_run"]) == (2, 1, 1)
    assert len(manifest["trace"]) == 5 and all(x["attempts"] == 1 and not x["codes"] for x in manifest["trace"])
    assert (manifest["wider_than_run"], manifest["requests"]["attempts"], manifest["requests"]["retry_after"]) == (0, 5, 0)
    assert manifest["clusters_by_year"] == [{"year": 1801, "api_count": 2, "stored": 2, "pages": 2}]
    again = Server(children=[{"results": []}])
    assert [x["cluster_id"] for x in rest.mirror_children(again.client(), "http://h/children", tmp_path / "clusters", tmp_path / "opinions")] == [2]


@pytest.mark.parametrize(
    ("body", "match"),
    [({"results": [parent(1), parent(1)]}, "twice"), ({"count": 3, "results": [parent(1)]}, "1 records stored, 3 declared"), ({"results": [{"id": 1}]}, "is absent"), ({"results": [{**parent(1), "citations": {}}]}, "is no array")],
)
def test_bad_listings(tmp_path, body, match):
    with pytest.raises((RuntimeError, ValueError), match=match):
        rest.mirror_span(Server(p=[body]).client(), "http://h/p", ("1801-01-01", "1801-12-31"), tmp_path, {})


def test_bad_children(tmp_path):
    rest.store(tmp_path, parent(1, 10))
    for body, match in (({"results": [], "next": "x"}, "several pages"), ({"results": []}, "absent")):
        with pytest.raises(RuntimeError, match=match):
            rest.mirror_children(Server(c=[body]).client(), "http://h/c", tmp_path, tmp_path)


def test_unique_records_of_a_span():
    assert rest.spans("1801-05-01", "1803-02-01") == [("1801-05-01", "1801-12-31"), ("1802-01-01", "1802-12-31"), ("1803-01-01", "1803-02-01")]
    assert rest.spans("1801-05-01", "1801-06-01") == [("1801-05-01", "1801-06-01")] and rest.spans("1801-05-01", "1800-06-01") == []
    server = Server(p=[{"results": [{"id": 1}, {"id": 1}]}, {"results": [{"id": 1}, {"id": 2}]}])
    assert [r["id"] for r in rest.fetch_unique(server.client(), "http://h/p", "1801-01-01", "1802-12-31")] == [1, 2]


def mirror(root):
    for folder in archive.FOLDERS:
        (root / folder).mkdir(parents=True)
    (root / "clusters/1.json").write_text("{}")
    (root / "opinions/10.json").write_text('{"a": 1}')
    return root


def test_archive_is_stable_and_verified(tmp_path):
    raw, ledger, pack = mirror(tmp_path / "raw"), tmp_path / "CHECKSUMS", tmp_path / "mirror.tar.gz"
    first = archive.pack(raw, pack)
    assert archive.pack(raw, tmp_path / "again.tar.gz") == first
    assert archive.package(raw, pack, ledger) == first
    data = pack.read_bytes()
    target = tmp_path / "copy"
    target.mkdir()
    (tmp_path / "got").mkdir()
    assert archive.fetch("http://h/a", target, ledger, tmp_path / "got/mirror.tar.gz", lambda r, timeout: io.BytesIO(data)) == 2
    assert archive.verify(target, archive.read_ledger(ledger)) == []
    (target / "clusters/1.json").write_text("[]")
    (target / "clusters/2.json").write_text("{}")
    (target / "opinions/10.json").unlink()
    assert archive.verify(target, archive.read_ledger(ledger)) == [("clusters/1.json", "hash mismatch"), ("clusters/2.json", "not in ledger"), ("opinions/10.json", "missing")]
    with pytest.raises(RuntimeError, match="hash"):
        archive.fetch("http://h/a", target, ledger, tmp_path / "got/mirror.tar.gz", lambda r, timeout: io.BytesIO(b"x"))


def test_unsafe_members():
    names = {"clusters/1.json": True, "/clusters/1.json": False, "clusters/../x": False, "other/1.json": False}
    assert {n: archive.admitted(tarfile.TarInfo(n), "/tmp") is not None for n in names} == names
    link = tarfile.TarInfo("clusters/l")
    link.type = tarfile.SYMTYPE
    assert archive.admitted(link, "/tmp") is None


def test_ledgers_and_csv(spark, tmp_path):
    (tmp_path / "scope.csv").write_text('cluster_id,disposition,rationale\n1,keep,"a, b"\n,drop,x\n1, drop ,later\n2,other,\n')
    assert sorted(tuple(r) for r in records.read_scope_ledger(spark, f"{tmp_path}/scope.csv").collect()) == [(1, "drop"), (2, "other")]
    assert records.read_scope_ledger(spark, f"{tmp_path}/none.csv").collect() == [] and records.read_pair_ledger(spark, f"{tmp_path}/none.csv").collect() == []
    (tmp_path / "key.csv").write_text("reporter,rep_vol,us_vol,name,page,year\nx,2,9,N,007,1800\nx,2,9,M,1,1800\n")
    assert [tuple(r) for r in records.read_answer_key(spark, f"{tmp_path}/key.csv").orderBy("ord").collect()] == [(2, "007", "N", "1800", 1), (2, "1", "M", "1800", 2)]
    records.write_csv(spark.createDataFrame([(1, None)], "a int, b string"), f"{tmp_path}/out", ("b", "a", "c"))
    assert next((tmp_path / "out").glob("*.csv")).read_text() == "b,a,c\n,1,\n"
    (tmp_path / "sums").write_text("ab  clusters/1.json\n\ncd  x  y\n")
    assert sorted(tuple(r) for r in records.read_checksums(spark, f"{tmp_path}/sums").collect()) == [("clusters/1.json", "ab"), ("x  y", "cd")]


def test_raw_contracts(spark, tmp_path):
    (tmp_path / "1.json").write_text(json.dumps(parent(1)))
    (tmp_path / "2.json").write_text('{"id": "x"}')
    found = records.check_contract(records.read_raw(spark, str(tmp_path)), "cluster").collect()
    assert {r.name for r in found} == {"2.json"} and len(found) == 6


def test_ingest_keeps_the_newest_reading(spark, tmp_path):
    (tmp_path / "in").mkdir()
    run = lambda: ingest.ingest(spark, f"{tmp_path}/in", records.schema(id=records.LONG, v=records.LONG, t=records.TEXT), f"{tmp_path}/table", f"{tmp_path}/cp", "id", "v").awaitTermination()
    (tmp_path / "in/a.json").write_text('{"id": 1, "v": 1, "t": "a"}')
    (tmp_path / "in/b.json").write_text('{"id": 2, "v": 5, "t": "b"}')
    run()
    (tmp_path / "in/c.json").write_text('{"id": 1, "v": 2, "t": "c"}')
    (tmp_path / "in/d.json").write_text('{"id": 2, "v": 4, "t": "late"}')
    run()
    run()
    assert sorted((r.id, r.t) for r in ingest.latest(spark, f"{tmp_path}/table").collect()) == [(1, "c"), (2, "b")]
    ingest.upsert(spark.createDataFrame([(3, 1, "x")], "id long, v long, t string"), 1, f"{tmp_path}/table", "id", "v")
    assert sorted(r.id for r in ingest.latest(spark, f"{tmp_path}/table").collect()) == [1, 2, 3]


def test_batches_rewrite_the_buckets_they_touch(spark, tmp_path):
    make = lambda rows: spark.createDataFrame(rows, "id long, v long, t string")
    t = f"{tmp_path}/table"
    ingest.upsert(make([(i, 0, "a") for i in range(60)]), 0, t, "id", "v", 8)
    before = ingest.versions(spark, t)
    assert sorted(before) == list(range(8))
    for n in (1, 2, 3):
        ingest.upsert(make([(5, n, str(n))]), n, t, "id", "v", 8)
    after = ingest.versions(spark, t)
    changed = [b for b in after if after[b] != before[b]]
    assert len(changed) == 1 and after[changed[0]] == [2, 3]
    ingest.upsert(make([(5, 3, "3")]), 3, t, "id", "v", 8)
    assert {r.id: r.t for r in ingest.latest(spark, t).collect()} == {i: "3" if i == 5 else "a" for i in range(60)}


def test_stages_from_files_to_tables(spark, tmp_path):
    raw = tmp_path / "raw"
    for folder in archive.FOLDERS:
        (raw / folder).mkdir(parents=True)
    words = " ".join(f"w{i}" for i in range(80))
    cite = lambda v, p: [{"reporter": "U.S.", "volume": v, "page": p, "type": 1, "date_created": "x"}]
    for i, name, c, kids in ((1, "Alpha v. Beta", cite("5", "1"), [10, 11]), (2, "Alpha versus Beta and others", cite("5", "1"), [20]), (3, "Respublica v. X", cite("2", "9"), [30]), (4, "Gamma", cite("19", "2"), [])):
        rest.store(raw / "clusters", parent(i, *kids) | {"case_name": name, "citations": c, "scdb_id": "s1" if i == 1 else ""})
    for i, p, html in ((10, 1, f"<p>{words} tbe ■ [*2] end</p>"), (11, 1, "<p>short</p>"), (20, 2, f"<p>{words} tbe</p>"), (30, 3, "<p>x</p>")):
        rest.store(raw / "opinions", {"id": i, "cluster": f"/c/{p}/", "type": "lead", "html": html, "html_lawbox": " "})
    (tmp_path / "pairs.csv").write_text("cluster_id,dup_of,disposition\n")
    (tmp_path / "key.csv").write_text("rep_vol,page,name,year\n5,1,Alpha v. Beta,1801\n6,1,Lost v. Found,1801\n")
    s = f"{tmp_path}/staging"
    assert stages.materialize(spark, str(raw), s) == {"n_clusters": 4, "n_opinions": 4}
    assert stages.scope(spark, s, f"{tmp_path}/none.csv") == {"false": 1, "true": 3}
    assert stages.dedup(spark, s, f"{tmp_path}/pairs.csv") == {"canonical": 2, "duplicate": 1}
    report = stages.validate(spark, s, f"{tmp_path}/key.csv", f"{tmp_path}/report")
    assert "volume 6: missing on page 1 “Lost v. Found”" in report and next((tmp_path / "report").glob("*.csv")).read_text().startswith("volume,n_keep")
    assert stages.reselect(spark, s) == {"source_html": 2}
    assert stages.clean_texts(spark, s) == {"texts": 2, "page_breaks": 1, "with_suspects": 1}
    found = stages.load(spark, s, f"{tmp_path}/out")
    assert (found["n_clusters_total"], found["n_decisions"], found["n_clusters_duplicate"], found["n_clusters_outside_volume"], found["n_clusters_not_scotus"]) == (4, 1, 1, 1, 1)
    assert found["n_corpus_opinions"] == 2 and found["n_ocr_suspects"] == 2
    assert spark.table("scotus_decisions").select("cluster_id").collect()[0][0] == 1


def test_settings(tmp_path, monkeypatch):
    monkeypatch.delenv(config.TOKEN_VARIABLE, raising=False)
    with pytest.raises(RuntimeError, match=config.TOKEN_VARIABLE):
        config.api_token(tmp_path / "none")
    (tmp_path / ".env").write_text(f"A=1\n{config.TOKEN_VARIABLE} = 'abc'\n")
    assert config.headers(config.api_token(tmp_path / ".env"))["Authorization"] == "Token abc"
    monkeypatch.setenv(config.TOKEN_VARIABLE, "env")
    assert config.api_token(tmp_path / ".env") == "env"
    assert config.Folders(tmp_path / "x").make().raw.is_dir()


def test_mirror_gaps(spark, tmp_path):
    raw = mirror(tmp_path / "raw")
    rest.store(raw / "clusters", parent(1, 10, 11))
    (raw / "opinions/10.json").write_text('{"id": 10, "cluster": "/c/1/", "type": "t"}')
    (raw / "opinions/12.json").write_text('{"id": 12, "cluster": "/c/9/", "type": "t"}')
    missing, lost = stages.mirror_gaps(spark, str(raw))
    assert [tuple(r) for r in missing.collect()] == [(1, 11)] and [tuple(r) for r in lost.collect()] == [(12, 9)]


def test_materialize_drops_older_tables(spark, tmp_path):
    raw = mirror(tmp_path / "raw")
    rest.store(raw / "clusters", parent(1))
    (raw / "opinions/10.json").write_text('{"id": 10, "cluster": "/c/1/", "type": "t"}')
    (tmp_path / "staging/stg_opinion_clean").mkdir(parents=True)
    stages.materialize(spark, str(raw), f"{tmp_path}/staging")
    assert not (tmp_path / "staging/stg_opinion_clean").exists()


def test_hashes_in_spark_match(spark, tmp_path):
    raw = mirror(tmp_path / "raw")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(str(raw))
    got = {r.path.split("/")[-1]: r.h for r in files.select("path", F.sha2("content", 256).alias("h")).collect()}
    assert got == {"1.json": hashlib.sha256(b"{}").hexdigest(), "10.json": archive.sha256(raw / "opinions/10.json")}
    assert issubclass(checks.IntegrityError, RuntimeError)


def test_auxiliary_texts_from_files(spark, tmp_path):
    rows = [{"id": 1, "summary": " s ", "disposition": "d", "headmatter": "h", "attorneys": " A "}, {"id": 2, "syllabus": "text", "judges": " "}, {"id": 3, "summary": " "}, {"id": 9, "summary": "not in the corpus"}]
    (tmp_path / "raw.json").write_text(json.dumps(rows))
    (tmp_path / "labels.csv").write_text("cluster_id,bucket,dedup_role,dup_of\n1,KEEP,canonical,\n2,KEEP,duplicate,1\n3,KEEP,canonical,\n")
    out = f"{tmp_path}/out"
    with pytest.raises(checks.IntegrityError, match="no labels"):
        stages.auxiliary(spark, f"{tmp_path}/raw.json", f"{tmp_path}/none.csv", out)
    found = stages.auxiliary(spark, f"{tmp_path}/raw.json", f"{tmp_path}/labels.csv", out)
    assert found == {"kind_summary": 1, "kind_headmatter": 1, "kind_disposition": 1, "kind_syllabus": 1, "n_texts": 4, "n_clusters_with_text": 2, "n_meta": 1, "n_skipped": 1}
    texts = spark.read.parquet(f"{out}/cluster_text").collect()
    assert {(r.cluster_id, r.canonical_cluster_id, r.kind) for r in texts} == {(1, 1, "summary"), (1, 1, "headmatter"), (1, 1, "disposition"), (2, 1, "syllabus")}
    manifest = next((tmp_path / "out/manifest").glob("*.csv")).read_text().splitlines()
    assert manifest[1:] == ["1,KEEP,canonical,1,summary;headmatter;disposition,5", "2,KEEP,duplicate,1,syllabus,4"]
    assert stages.auxiliary(spark, f"{tmp_path}/raw.json", f"{tmp_path}/labels.csv", out) == found


def test_mirror_goes_round(tmp_path):
    """Packed with its ledger by one stage, fetched by the other."""
    raw = mirror(tmp_path / "raw")
    args = type("Args", (), {"raw": str(raw), "target": str(tmp_path / "m.tar.gz"), "ledger": str(tmp_path / "SUMS")})
    stages.STAGES["package-mirror"](None, args)
    (tmp_path / "there").mkdir()
    (tmp_path / "got").mkdir()
    data = (tmp_path / "m.tar.gz").read_bytes()
    assert archive.fetch("http://h/m", tmp_path / "there", tmp_path / "SUMS", tmp_path / "got/m.tar.gz", lambda r, timeout: io.BytesIO(data)) == 2
    assert (tmp_path / "there/opinions/10.json").read_text() == '{"a": 1}'


def test_extract_says_that_the_mirror_is_wider(tmp_path):
    (tmp_path / "clusters").mkdir()
    rest.store(tmp_path / "clusters", parent(77))
    server = Server(parents=[{"results": [parent(1)]}], children=[{"results": []}, {"results": []}])
    manifest = rest.extract(server.client(), "http://h/parents", "http://h/children", "1801-01-01", "1801-12-31", tmp_path)
    assert (manifest["n_clusters"], manifest["wider_than_run"]) == (2, 1)


def test_json_lines_and_arrays(spark, tmp_path):
    rows = spark.createDataFrame([(2, None, "ü"), (1, 5, "x")], "b long, a int, c string")
    records.write_json(rows.coalesce(1), f"{tmp_path}/lines")
    text = next((tmp_path / "lines").glob("part-*")).read_text(encoding="utf-8")
    assert text.splitlines() == ['{"a":null,"b":2,"c":"ü"}', '{"a":5,"b":1,"c":"x"}']
    (tmp_path / "array.json").write_text(f"[{','.join(text.splitlines())}]", encoding="utf-8")
    got = records.read_array(spark, f"{tmp_path}/array.json", records.schema(b=records.LONG, a=records.INT, c=records.TEXT))
    assert sorted(map(tuple, got.collect())) == [(1, 5, "x"), (2, None, "ü")]


def test_last_row_of_the_last_file_counts(spark, tmp_path):
    folder = tmp_path / "ledger"
    folder.mkdir()
    (folder / "a.csv").write_text("cluster_id,disposition\n1,keep\n2,drop\n")
    (folder / "b.csv").write_text("cluster_id,disposition\n" + "".join(f"{i},keep\n" for i in range(10, 3000)) + "1,keep\n")
    (folder / "c.csv").write_text("cluster_id,disposition\n1,drop\n")
    got = {r.cluster_id: r.disposition for r in records.read_scope_ledger(spark, str(folder)).collect()}
    assert (got[1], got[2], len(got)) == ("drop", "drop", 2992)
    keys = tmp_path / "keys"
    keys.mkdir()
    (keys / "a.csv").write_text("rep_vol,page,name,year\n2,1,A,1801\n")
    (keys / "b.csv").write_text("rep_vol,page,name,year\n" + "".join(f"2,{i},B{i},\n" for i in range(2, 900)))
    (keys / "c.csv").write_text("rep_vol,page,name,year\n2,900,C,\n")
    assert [r.page for r in records.read_answer_key(spark, str(keys)).orderBy("ord").collect()] == [str(i) for i in range(1, 901)]
