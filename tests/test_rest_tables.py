"""A REST API as tables, against a server on this machine."""

import http.server
import json
import threading
import urllib.parse
from collections import Counter

import pytest

from lexmill.sources import rest_tables

PARENTS = {1801: [1, 2, 3], 1802: [], 1803: [4], 1804: [5, 6]}
CHILDREN = {1: [10, 11], 2: [], 4: [12]}


def parent(i):
    return {"id": i, "case_name": f"né {i}", "date_filed": "1801-01-01", "citations": [], "source": "U", "sub_opinions": [f"/o/{c}/" for c in CHILDREN.get(i, ())]}


@pytest.fixture
def server():
    asked, broken = Counter(), Counter()

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            query = dict(urllib.parse.parse_qsl(urllib.parse.urlparse(self.path).query))
            asked[self.path.split("?")[0] + ":" + (query.get("date_filed__gte") or query.get("cluster") or "")[:4]] += 1
            if "cluster" in query:
                body = {"results": [{"id": c, "cluster": f"/c/{query['cluster']}/", "type": "t"} for c in CHILDREN.get(int(query["cluster"]), ())]}
            else:
                year, page = int(query["date_filed__gte"][:4]), int(query.get("page", 1))
                ids = PARENTS[year]
                body = {"count": len(ids) + (broken["count"] == year), "results": [parent(i) for i in ids[2 * page - 2 : 2 * page]]}
                if 2 * page < len(ids):
                    body["next"] = f"http://127.0.0.1:{self.server.server_port}{self.path}&page={page + 1}"
            code = 503 if broken["503"] > 0 else 200
            broken["503"] -= 1
            self.send_response(code)
            self.end_headers()
            self.wfile.write(json.dumps(body).encode())

        def log_message(self, *args):
            pass

    made = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=made.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{made.server_port}", asked, broken
    made.shutdown()


def test_listing_mirror_and_resume(spark, tmp_path, server):
    url, asked, broken = server
    every = [i for ids in PARENTS.values() for i in ids]
    broken["503"] = 1
    rows = rest_tables.listing(spark, f"{url}/p", "1801-02-01", "1804-09-30", patience=0.01).collect()
    assert sorted((r.id, r.year, r.page) for r in rows) == [(1, 1801, 0), (2, 1801, 0), (3, 1801, 1), (4, 1803, 0), (5, 1804, 0), (6, 1804, 0)]
    assert all(json.loads(r.record) == parent(r.id) for r in rows)
    target, args = f"{tmp_path}/mirror", (spark, f"{url}/p", "1801-02-01", "1804-09-30")
    asked.clear()
    broken["count"] = 1804  # the second group of years fails
    with pytest.raises(Exception, match="2 records came, 3 declared"):
        rest_tables.mirror(*args, target, streams=2, patience=0.01)
    assert sorted(r.id for r in rest_tables.mirrored(spark, target).collect()) == [1, 2, 3]
    asked.clear()
    broken["count"] = 0
    assert rest_tables.mirror(*args, target, streams=2, patience=0.01) == [1803, 1804]
    assert set(asked) == {"/p:1803", "/p:1804"}  # none again
    assert sorted(r.id for r in rest_tables.mirrored(spark, target).collect()) == every and rest_tables.mirror(*args, target) == []


def test_children(spark, server):
    url, asked, _ = server
    parents = spark.createDataFrame([(i, CHILDREN.get(i, [])) for i in (1, 2, 4)], "cluster_id long, wanted array<long>")
    found = sorted((r.id, r.cluster_id) for r in rest_tables.children(parents, f"{url}/c", patience=0.001).collect())
    assert found == [(10, 1), (11, 1), (12, 4)]
    asked.clear()
    known = spark.createDataFrame([(10,), (11,)], "id long")
    assert [r.id for r in rest_tables.children(parents, f"{url}/c", known, patience=0.001).collect()] == [12] and set(asked) == {"/c:2", "/c:4"}
    absent = spark.createDataFrame([(4, [12, 99])], "cluster_id long, wanted array<long>")
    with pytest.raises(Exception, match=r"children of 4 are absent: \[99\]"):
        rest_tables.children(absent, f"{url}/c", patience=0.001).collect()


def test_an_empty_span(spark):
    assert rest_tables.listing(spark, "http://127.0.0.1:9/p", "1804-01-01", "1801-01-01").collect() == []
