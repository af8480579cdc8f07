"""Hierarchies, rules, resolution, reconciliation, publishing and snapshots on hand-worked cases."""

import argparse

import pytest
from pyspark.sql import functions as F

from lexmill.operators import classify, components, hierarchy, publish, reconcile, resolve, search, snapshots, versions
from lexmill.plans import checks, reports, stages

PARENT = "id long, case_name string, case_name_full string, date_filed string, citations array<struct<reporter:string,volume:string,page:string,type:int>>, scdb_id string, source string, citation_count int, precedential_status string, sub_opinions array<string>"
CHILD = "id long, cluster_id long, cluster string, type string, author_str string, extracted_by_ocr boolean, ordering_key int, html string, plain_text string"


def parents(spark, declared):
    return hierarchy.normalize_parents(spark.createDataFrame([(i, "A v. B", "", "1801-02-03", [("U.S.", "5", "1", 1)], "", "U", 0, "P", [f"/o/{c}/" for c in cs]) for i, cs in declared.items()], PARENT))


def children(spark, of):
    return hierarchy.normalize_children(spark.createDataFrame([(i, None, f"/c/{p}/", "lead", "", None, None, " \n", " x ") for i, p in of.items()], CHILD))


def test_linking(spark):
    ps, cs = parents(spark, {1: [10], 2: [20, 21]}), children(spark, {10: 1, 20: 2, 21: 2, 22: 2})
    assert {r.cluster_id: r.n_opinions for r in hierarchy.link(ps, cs).collect()} == {1: 1, 2: 3}
    row = ps.first()
    assert (row.us_volume, row.us_page, row.us_cite, row.case_name_full, row.scdb_id) == (5, "1", "5 U.S. 1", None, None)
    row = cs.orderBy("opinion_id").first()
    assert (row.source_html, row.source_plain_text, row.is_ocr_extracted, row.author) == (None, " x ", False, None)


def test_broken_links_raise(spark):
    with pytest.raises(checks.IntegrityError, match="without a parent"):
        hierarchy.link(parents(spark, {1: []}), children(spark, {10: 1, 11: 9}))
    with pytest.raises(checks.IntegrityError, match="absent"):
        hierarchy.link(parents(spark, {1: [10, 11]}), children(spark, {10: 1}))


def test_what_is_left_to_fetch(spark):
    ps, cs = parents(spark, {1: [10], 2: [20, 21], 3: []}), children(spark, {10: 1, 20: 2})
    assert sorted(r[0] for r in hierarchy.to_fetch(ps, cs, "cluster_id", "declared_ids", "opinion_id").collect()) == [2, 3]


SCOPE = [
    ((None, 6, "1", "s"), ("false", "no_us_reports_cite")), (("c", 1, "1", "s"), ("false", "out_of_scope_volume")), (("c", 20, "1", None), ("false", "out_of_scope_volume")),
    (("c", None, "1", None), ("false", "out_of_scope_volume")), (("c", 6, "1", "s"), ("true", "scotus_reporter+scdb")), (("c", 6, "1", None), ("true", "scotus_only_reporter")),
    (("c", 19, "1", "s"), ("true", "scotus_reporter+scdb")), (("c", 3, "1", "s"), ("true", "scdb_id")), (("c", 4, "200", None), ("false", "dallas_not_in_scdb")),
    (("c", 2, "400a", ""), ("false", "dallas_not_in_scdb:page_before_scotus_start")),
]


def test_scope(spark):
    rows = [(i, "X v. Y", *x) for i, (x, _) in enumerate(SCOPE)] + [(90, "X", None, 1, "1", None), (91, "X", "c", 6, "1", "s"), (92, "Respublica v. Lessee of the Commonwealth", "c", 2, "9", None)]
    df = spark.createDataFrame(rows, "cluster_id long, case_name string, us_cite string, us_volume int, us_page string, scdb_id string")
    ledger = spark.createDataFrame([(90, "keep"), (91, "drop"), (0, "other")], "cluster_id long, disposition string")
    got = {r.cluster_id: (r.is_scotus, r.evidence) for r in classify.scope(df, ledger).collect()}
    assert [got[i] for i in range(len(SCOPE))] == [w for _, w in SCOPE]
    assert got[90] == ("true", "human_review") and got[91] == ("false", "human_review")
    assert got[92][1] == "dallas_not_in_scdb:respublica/commonwealth;lessee_ejectment;page_before_scotus_start"


RECORD = "cluster_id long, us_volume int, us_page string, case_name string, scdb_id string, year string, shingles array<string>"


def text(name, n=200):
    return [f"{name} {i}" for i in range(n)]


def resolved(spark, rows, pairs=()):
    df = spark.createDataFrame(rows, RECORD)
    ledger = spark.createDataFrame(list(pairs), "cluster_id long, dup_of long")
    return {r.cluster_id: (r.dup_of, r.dup_method) for r in resolve.resolve(df, ledger).collect()}


def test_pairs_of_one_page(spark):
    got = resolved(spark, [
        (1, 5, "1", "Smith v. Jones", "a", None, text("s")), (2, 5, "1", "Smith v. Jones", "b", None, text("s")),
        (3, 5, "20", "Smith v. Jones", None, None, []), (4, 5, "20", "Jones v. Smith", None, None, text("q", 3)),
        (5, 5, "40", "The Alexander", None, None, text("t")), (6, 5, "40", "Picket against the Master of a vessel", None, None, text("t")),
        (7, 5, "60", "Alpha", None, None, text("u", 20)), (8, 5, "60", "Beta", None, None, text("u", 20)),
    ])
    assert got == {1: (None, None), 2: (None, None), 3: (4, "name"), 4: (None, None), 5: (None, None), 6: (5, "text"), 7: (None, None), 8: (None, None)}


def test_a_stub_joins_one_anchor(spark):
    got = resolved(spark, [(1, 5, "1", "Alpha v. Beta", "a", None, text("s")), (2, 5, "1", "Gamma v. Delta", "b", None, text("s")), (3, 5, "1", "Epsilon", None, None, text("s", 100))])
    assert got == {1: (None, None), 2: (None, None), 3: (1, "text")}


def test_across_pages(spark):
    far = [(1, 5, "27", "The Diana", None, "1818", text("d")), (2, 5, "58", "The Diana", None, "1818", text("d"))]
    assert resolved(spark, far) == {1: (None, None), 2: (1, "off_page")}
    assert resolved(spark, [far[0], (*far[1][:6], text("e"))])[2] == (None, None)
    assert resolved(spark, [far[0], (2, 5, "58", "The Diana", None, "1819", text("d"))])[2] == (None, None)
    assert resolved(spark, [far[0], (2, 5, "58", "The Diana", None, None, text("d"))])[2] == (1, "off_page")
    assert resolved(spark, [far[0], (2, 5, "29", "The Diana", None, None, text("z", 10))])[2] == (1, "off_page")
    assert resolved(spark, [far[0], (2, 5, "30", "The Diana", None, None, text("z", 10))])[2] == (None, None)
    assert resolved(spark, [far[0], (2, 6, "58", "The Diana", None, "1818", text("d"))])[2] == (None, None)


def test_review_ledger(spark):
    rows = [(1, 5, "1", "Alpha", "a", None, text("a")), (2, 5, "9", "Beta", "b", None, text("b")), (3, 5, "9", "Beta", None, None, []), (4, 6, "1", "Gamma", None, None, [])]
    assert resolved(spark, rows, [(2, 1)]) == {1: (None, None), 2: (1, "human_review"), 3: (1, "human_review"), 4: (None, None)}
    assert resolved(spark, rows, [(1, 2)])[2] == (1, "human_review")
    assert resolved(spark, rows, [(3, 2)])[3] == (2, "name")
    with pytest.raises(checks.IntegrityError, match="unknown"):
        resolved(spark, rows, [(1, 77)])
    with pytest.raises(checks.IntegrityError, match="crosses"):
        resolved(spark, rows, [(1, 4)])


def test_linked_through_a_third(spark):
    rows = [(1, 5, "1", "A", None, None, text("x", 100)), (2, 5, "1", "B", None, None, text("x", 60) + text("y", 60)), (3, 5, "1", "C", None, None, text("y", 90))]
    assert resolved(spark, rows) == {1: (2, "text"), 2: (None, None), 3: (2, "text")}
    rows = [(1, 5, "1", "A", None, None, text("x", 200)), (2, 5, "1", "B", None, None, text("x", 60) + text("y", 60)), (3, 5, "1", "C", None, None, text("y", 90))]
    assert resolved(spark, rows) == {1: (None, None), 2: (1, "text"), 3: (1, "grouped")}


def test_ledger_rows(spark):
    make = lambda *rows: resolve.read_ledger(spark.createDataFrame(rows, "cluster_id string, dup_of string, disposition string"))
    assert [tuple(r) for r in make(("2", "1", " duplicate "), (None, "9", "x"), ("", "9", "x")).collect()] == [(2, 1)]
    with pytest.raises(checks.IntegrityError, match="dispositions"):
        make(("2", "1", "dup"))
    with pytest.raises(checks.IntegrityError, match="themselves"):
        make(("2", "2", "duplicate"))


def test_components(spark):
    edges = [(2, 1), (3, 2), (4, 3), (9, 8), (7, 8), (20, 10), (10, 15)] + [(100 + i + 1, 100 + i) for i in range(40)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {2: 1, 3: 1, 4: 1, 9: 7, 8: 7, 20: 10, 15: 10} | {100 + i: 100 for i in range(1, 41)}


def test_reconciliation(spark):
    key = [(2, "1", "Henry v. Ball", 0), (2, "5", "Jones v. Shore", 1), (2, "9", "Marbury v. Madison", 2), (3, "1", "Lost v. Found", 0)]
    kept = [(1, 2, "1", "Negress Sally Henry by William Henry her Father v. Ball"), (2, 2, "5", "Jones v. Shore's Executors"), (3, 2, "77", "Marbury v. Madison"), (4, 2, "80", "Marbury vs Madison"), (5, 2, "99", "Nobody Else")]
    summary, detail = reconcile.reconcile(
        spark.createDataFrame([(*k[:3], "1800", k[3]) for k in key], "us_volume int, page string, name string, year string, ord int"),
        spark.createDataFrame(kept, "cluster_id long, us_volume int, us_page string, case_name string"), 2, 4,
    )
    assert sorted(tuple(r) for r in summary.collect()) == [(2, 5, 3, 3, 0, 2), (3, 0, 1, 0, 1, 0), (4, 0, 0, 0, 0, 0)]
    assert {(r.kind, r.cluster_id) for r in detail.collect()} == {("residual_duplicate", 4), ("anomaly", 5), ("missing", None)}
    report = list(reconcile.format_report(summary, detail))
    assert [x.strip() for x in report[2].split("|")[1:-1]] == ["2", "5", "3", "3", "0", "2", "no"] and [x.strip() for x in report[5].split("|")[1:-1]] == ["all", "5", "4", "3", "1", "2", "no"]
    assert report[6:] == ["volume 2: residual duplicate on page 80 id 4 “Marbury vs Madison”", "volume 2: anomaly on page 99 id 5 “Nobody Else”", "volume 3: missing on page 1 “Lost v. Found”"]


STATUS = [((0, None, None), "not_scotus"), ((1, "duplicate", 99), "duplicate"), ((1, "canonical", 2), "included"), ((1, "canonical", 18), "included"), ((1, "canonical", 19), "outside_volume"),
          ((0, "canonical", 5), None), ((1, None, 5), None), ((1, "canonical", None), None), ((None, None, 5), None)]


def test_status(spark):
    df = spark.createDataFrame([(i, *x) for i, (x, _) in enumerate(STATUS)], "i int, f int, r string, v int")
    got = df.select("i", publish.corpus_status(F.col("f"), F.col("r"), F.col("v")).alias("s")).orderBy("i").collect()
    assert [r.s for r in got] == [w for _, w in STATUS]


def staging(spark, root, change=None):
    tables = {
        "stg_clusters": ([(1, "A", 5, "1", "5 U.S. 1", "1801", "s", [("U.S.", "5", "1", 1), ("U.S.", "5", "1", 2), (None, None, "3", 1)]), (2, "B", 5, "1", "5 U.S. 1", "1801", None, []), (3, "C", 1, "1", "1 U.S. 1", "1790", None, []), (4, "D", 19, "2", "19 U.S. 2", "1821", None, [])],
                         "cluster_id long, case_name string, us_volume int, us_page string, us_cite string, date_filed string, scdb_id string, citations array<struct<reporter:string,volume:string,page:string,type:int>>"),
        "stg_cluster_scope": ([(1, "true", "e"), (2, "true", "e"), (3, "false", "e"), (4, "true", "e")], "cluster_id long, is_scotus string, evidence string"),
        "stg_cluster_dedup": ([(1, "canonical", None, None), (2, "duplicate", 1, "name"), (4, "canonical", None, None)], "cluster_id long, dedup_role string, dup_of long, dup_method string"),
        "stg_opinions": ([(10, 1, "lead", None, True, 1), (11, 1, "conc", None, False, 2), (20, 2, "x", None, None, None)], "opinion_id long, cluster_id long, type string, author string, is_ocr_extracted boolean, ordering_key int"),
        "stg_opinion_source": ([(10, "source_html", True), (11, "source_html", False)], "opinion_id long, chosen_source string, is_ocr_dirty boolean"),
        "stg_opinion_clean": ([(10, "tbe state ■", '{"count":2,"hits":[{"offset":0,"token":"tbe"},{"offset":10,"token":"■"}]}', 1), (11, "a concurrence, necessary and proper", None, 1)], "opinion_id long, clean_text string, ocr_suspect string, clean_version int"),
        "stg_page_break": ([(10, 1, "2", 4, "state ■")], "opinion_id long, ordinal int, page_label string, char_offset long, anchor string"),
        "stg_meta": ([("git_commit", "abc")], "key string, value string"),
    }
    for name, (rows, schema) in (tables | (change or {})).items():
        spark.createDataFrame(rows, schema if schema else tables[name][1]).write.mode("overwrite").parquet(f"{root}/{name}")


def test_publish(spark, tmp_path):
    staging(spark, f"{tmp_path}/s")
    found = publish.build(spark, f"{tmp_path}/s", f"{tmp_path}/out", {"built_at": "now"})
    assert found == {
        "n_clusters_total": 4, "n_clusters_included": 1, "n_clusters_outside_volume": 1, "n_clusters_duplicate": 1, "n_clusters_not_scotus": 1, "n_decisions": 1, "n_opinions": 3,
        "n_corpus_opinions": 2, "n_review_ledger_folds": 0, "n_citations": 2, "n_citation_dupes_dropped": 1, "n_page_breaks": 1, "n_ocr_suspects": 2,
    }
    cites = spark.table("citations").orderBy(F.col("reporter").desc()).collect()
    assert [(c.reporter, c.volume, c.page, c.type) for c in cites] == [("U.S.", "5", "1", 1), (None, "None", "3", 1)]
    assert [tuple(r) for r in spark.table("ocr_suspects").orderBy("ordinal").collect()] == [(10, 1, 0, "tbe"), (10, 2, 10, "■")]
    assert spark.table("duplicate_clusters").first().canonical_case_name == "A"
    assert [tuple(r) for r in reports.report(spark, "search").collect()] == [("A", "5 U.S. 1")]
    for name in reports.SECTIONS:
        assert reports.report(spark, name).count() >= 1
    assert {r.key: r.value for r in spark.table("meta").collect()}["staging_git_commit"] == "abc"
    rules = publish.integrity(*[spark.table(t) for t in ("clusters", "opinions", "citations", "page_breaks", "ocr_suspects")])
    assert checks.suite(rules).agg(F.sum("violations")).first()[0] == 0


CORRUPT = [
    ({"stg_cluster_dedup": ([(1, "canonical", None, None), (2, "duplicate", None, "name"), (4, "canonical", None, None)], None)}, "duplicate_incomplete"),
    ({"stg_cluster_dedup": ([(1, "duplicate", 2, "name"), (2, "duplicate", 1, "name"), (4, "canonical", None, None)], None)}, "duplicate_target_not_canonical"),
    ({"stg_cluster_dedup": ([(1, "canonical", 4, None), (2, "duplicate", 1, "name"), (4, "canonical", None, None)], None)}, "fields_on_non_duplicate"),
    ({"stg_cluster_dedup": ([(1, "canonical", None, None), (2, "duplicate", 77, "name"), (4, "canonical", None, None)], None)}, "duplicate_target_not_canonical"),
    ({"stg_cluster_dedup": ([(1, "canonical", None, None), (4, "canonical", None, None)], None)}, "status_impossible"),
    ({"stg_cluster_scope": ([(1, "true", "e"), (2, "true", "e"), (3, "maybe", "e"), (4, "true", "e")], None)}, "scope_unrecognized"),
]


@pytest.mark.parametrize(("change", "rule"), CORRUPT)
def test_bad_staging_fails_the_build(spark, tmp_path, change, rule):
    staging(spark, f"{tmp_path}/s", change)
    with pytest.raises(checks.IntegrityError, match=rule):
        publish.build(spark, f"{tmp_path}/s", f"{tmp_path}/out")


def test_missing_stage_is_named(spark, tmp_path):
    with pytest.raises(checks.IntegrityError, match="stg_opinion_clean .run stage clean"):
        publish.staged_tables(spark, str(tmp_path))


def test_snapshot_diff(spark):
    make = lambda *rows: spark.createDataFrame(rows, "id string, record string")
    a = make(("1", '{"x": 1, "date_modified": "a"}'), ("2", '{"x": 1}'), ("3", '{"x": {"date_modified": 1}}'), ("4", "{}"), ("6", '{"a": 1, "b": 2}'))
    b = make(("1", '{"date_modified": "b", "x": 1}'), ("2", '{"x": 2}'), ("3", '{"x": {"date_modified": 2}}'), ("5", "{}"), ("6", '{"b": 2, "a": 1}'))
    assert {tuple(r) for r in snapshots.diff(a, b).collect()} == {("1", "volatile"), ("2", "substantive"), ("3", "substantive"), ("4", "only_a"), ("5", "only_b")}


@pytest.mark.parametrize("n, touched", [(1, 1), (700, 0), (3000, 30)])
def test_diff_joins_only_what_differs(spark, n, touched):
    a = spark.range(n).select(F.col("id").cast("string").alias("id"), F.to_json(F.struct(F.col("id").alias("x"))).alias("record"))
    b = a.withColumn("record", F.when(F.col("id").cast("long") < touched, '{"x": -1}').otherwise(F.col("record")))
    more = spark.createDataFrame([("new", "{}"), (None, "{}")], "id string, record string") if touched else b.limit(0)
    b = b.unionByName(more)
    got = sorted(map(tuple, snapshots.diff(a, b).collect()), key=str)
    assert got == sorted([(str(i), "substantive") for i in range(touched)] + ([("new", "only_b"), (None, "only_b")] if touched else []), key=str)
    levels = 2
    apart = snapshots.differing(*[snapshots.leaves(x, "id", "record", levels) for x in (a, b)], levels)
    assert (apart is None) == (not touched)
    if touched:
        assert apart.count() <= touched + 1 and snapshots.changed(a, apart, "id", levels).count() <= 2 * touched


def test_report_of_the_command_line(spark, tmp_path, capsys):
    staging(spark, f"{tmp_path}/s")
    publish.build(spark, f"{tmp_path}/s", f"{tmp_path}/out")
    assert stages.STAGES["report"](spark, argparse.Namespace(target=f"{tmp_path}/out")) == list(reports.SECTIONS)
    assert " | A | 5 U.S. 1" in capsys.readouterr().out


def test_stored_index_answers_like_the_whole(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(search, "BLOCK_IDS", 4)
    words = ["necessary", "próper", "Rare", "plain"]
    rows = [(i - 9, " ".join(w for k, w in enumerate(words) if i % (k + 2) == 0 or (w == "Rare" and i == 6))) for i in range(60)] + [(90, None), (91, ""), (92, "necessary, necessary")]
    texts = spark.createDataFrame(rows, "k long, t string")
    whole, path = search.inverted_index(texts, "k", "t"), f"{tmp_path}/index"
    search.write_index(search.inverted_index(texts.where("k < 30"), "k", "t"), path, "k", 0, 8)
    search.write_index(search.inverted_index(texts.where("k >= 30"), "k", "t"), path, "k", 1, 8)  # texts that came later
    for q in ("necessary proper", "PROPER", "absent", "proper OR necessary", "plain rare necessary", "absent necessary OR rare", "", "necessary absent"):
        want = sorted(r.k for r in search.match(whole, q, "k").collect())
        assert sorted(r.k for r in search.find(spark, path, q, "k", 8).collect()) == want
        assert sorted(r.k for r in search.match(search.inverted_index(texts, "k", "t", search.query_terms(spark, q)), q, "k").collect()) == want
    assert sorted(map(tuple, search.rows_of(search.read_blocks(spark, path), "k").collect())) == sorted(map(tuple, whole.collect()))
    plan = search.find(spark, path, "rare necessary", "k", 8)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [bucket" in plan
    assert "In(block" in plan and "EqualTo(term" in plan  # only the blocks of the rarest term


def test_killed_publish_leaves_the_version_before(spark, tmp_path, monkeypatch):
    out = f"{tmp_path}/out"
    staging(spark, f"{tmp_path}/s")
    publish.build(spark, f"{tmp_path}/s", out)
    want = {t: sorted(map(str, versions.table(spark, out, t).collect())) for t in ("clusters", "citations", "opinions", "page_breaks", "ocr_suspects")}
    assert versions.current(spark, out)["tables"]["citations"]["rows"] == 2
    staging(spark, f"{tmp_path}/s", {"stg_page_break": ([], None)})
    write, commit = versions.Draft.write, versions.Draft.commit
    for stop in range(6):
        def killed(self, name, df, *by, left=[stop], **asked):  # noqa: B006
            if not left[0]:
                raise KeyboardInterrupt
            left[0] -= 1
            return write(self, name, df, *by, **asked)

        monkeypatch.setattr(versions.Draft, "write", killed)
        with pytest.raises(KeyboardInterrupt):
            publish.build(spark, f"{tmp_path}/s", out)
        assert versions.current(spark, out)["version"] == 1
    monkeypatch.setattr(versions.Draft, "write", write)
    monkeypatch.setattr(versions.Draft, "commit", lambda self: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        publish.build(spark, f"{tmp_path}/s", out)
    assert {t: sorted(map(str, versions.table(spark, out, t).collect())) for t in want} == want
    monkeypatch.setattr(versions.Draft, "commit", commit)
    publish.build(spark, f"{tmp_path}/s", out)
    assert versions.table(spark, out, "page_breaks").count() == 0 and spark.table("page_breaks").count() == 0
    publish.build(spark, f"{tmp_path}/s", out)
    assert len(versions.numbers(spark, out, "v=")) == 2 and versions.current(spark, out)["version"] > 2


def test_lookup_of_hot_keys(spark, monkeypatch):
    from lexmill.operators import keyed

    monkeypatch.setattr(keyed, "HOT_PARTS", 4)
    rows = spark.createDataFrame([(i, "hot" if i % 2 else f"k{i % 6}") for i in range(40)] + [(99, "none")], "i long, k string")
    values = rows.where("k <> 'none'").groupBy("k").agg(F.count(F.lit(1)).alias("n")).withColumn("v", F.upper("k"))
    for how, more in (("inner", []), ("left", [(99, None)])):
        got = keyed.lookup(rows, values, "k", "n", 41, how)
        assert "n" not in got.columns
        assert sorted((r.i, r.v) for r in got.collect()) == sorted([(i, "HOT" if i % 2 else f"K{i % 6}") for i in range(40)] + more)


def test_captions_are_compared_by_many_tasks(spark, tmp_path):
    from lexmill.operators.captions import spread

    rows = spark.range(40).selectExpr("CAST(id AS string) AS a", "'x' AS b")
    spread(rows, "a", "b").groupBy("a").count().count()
    assert spread(rows, "a", "b").rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_names_are_compared_once_for_all_brands(spark, tmp_path, monkeypatch):
    from lexmill.operators import captions
    from lexmill.queries import matching

    seen = []
    ratio = captions.with_ratio
    monkeypatch.setattr(captions, "with_ratio", lambda pairs, *rest: seen.append(pairs.count()) or ratio(pairs, *rest))
    names = [(i, f"Brand#{i % 9}", "SMALL", n, 20) for i, n in enumerate(["hot plate", "hot plates", "blue gear"] * 9)]
    names = [(k, f"Brand#{k // 3}", *rest) for k, _, *rest in names]
    spark.createDataFrame(names, "p_partkey long, p_brand string, p_type string, p_name string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    got = sorted((r.left_key, r.right_key) for r in matching.name_similarity_pairs(spark, str(tmp_path)).collect())
    assert got == [(3 * i, 3 * i + 1) for i in range(9)]
    assert seen == [2]
